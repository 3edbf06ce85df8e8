"""A small rule language, ``lhs == rhs``, compiled to Catalyst columns on the driver.

Allowed are names, whole numbers, + - * and abs(x); anything else makes the
side null. A rule passes where a side is null (a name without value) and where
it doesn't hold exactly one ``==``.
"""

from __future__ import annotations

import ast
import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words of the language that name no variable.
_WORDS = frozenset("abs and or not if else true false".split())


def variables(formula: str) -> list[str]:
    """Names a formula refers to, in order of appearance."""
    return list(dict.fromkeys(n for n in re.findall(r"\b[a-z_]+\b", formula) if n not in _WORDS))


class _Refused(Exception):
    pass


_BINARY: dict[type, Callable[[Column, Column], Column]] = {ast.Add: lambda x, y: x + y, ast.Sub: lambda x, y: x - y, ast.Mult: lambda x, y: x * y}


def _compile(node: ast.AST, values: Mapping[str, Column]) -> Column:
    match node:
        case ast.Expression(body=body):
            return _compile(body, values)
        case ast.Constant(value=int() as v):
            return F.lit(int(v)).cast("bigint")
        case ast.Name(id=name) if name in values:
            return values[name]
        case ast.UnaryOp(op=ast.USub(), operand=x):
            return -_compile(x, values)
        case ast.UnaryOp(op=ast.UAdd(), operand=x):
            return _compile(x, values)
        case ast.BinOp(left=x, op=op, right=y) if type(op) in _BINARY:
            return _BINARY[type(op)](_compile(x, values), _compile(y, values))
        case ast.Call(func=ast.Name(id="abs"), args=[x], keywords=[]):
            return F.abs(_compile(x, values))
    raise _Refused


def compile_expression(text: str, values: Mapping[str, Column]) -> Column:
    """A side of a rule as a column; null for what the language doesn't allow."""
    try:
        return _compile(ast.parse(text.strip(), mode="eval"), values)
    except (_Refused, SyntaxError, ValueError, RecursionError):
        return F.lit(None).cast("bigint")


def compile_rule(formula: str, values: Mapping[str, Column], tolerance: float = 1.0) -> Column:
    """Struct ``(expected, actual, difference, match, missing)`` of a rule: its left and right sides compared with sign."""
    sides = formula.split("==")
    absent = F.array(*[F.lit(v) for v in variables(formula) if v not in values]).cast("array<string>")
    unbound = F.filter(F.array(*[F.when(values[v].isNull(), F.lit(v)) for v in variables(formula) if v in values]).cast("array<string>"), lambda x: x.isNotNull())
    left, right = [compile_expression(s, values) for s in sides] if len(sides) == 2 else [F.lit(None).cast("bigint")] * 2
    off = F.abs(left - right)
    return F.struct(left.alias("expected"), right.alias("actual"), off.alias("difference"), F.coalesce(off <= tolerance, F.lit(True)).alias("match"), F.concat(absent, unbound).alias("missing"))
