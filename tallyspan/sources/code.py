"""Source of program texts: the functions of Python files with their texts, sizes and complexities, as rows to embed and compare."""

from __future__ import annotations

import ast
import hashlib
import io
import tokenize
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from tallyspan.sources.filings import _documents, _per_file

FUNCTIONS = "doc_id string, name string, start_line int, end_line int, loc int, text string, tree string, told string, sha256 string, cyclomatic int, cognitive int"

_Function = ast.FunctionDef | ast.AsyncFunctionDef
_BRANCHES = (ast.If, ast.For, ast.AsyncFor, ast.While, ast.ExceptHandler, ast.IfExp, ast.match_case)
_NESTING = (ast.If, ast.For, ast.AsyncFor, ast.While, ast.ExceptHandler, ast.IfExp, ast.Match)


def cyclomatic(node: ast.AST) -> int:
    """Independent paths: one, and one for each branch, further operand of a logical expression, and loop or condition of a comprehension."""
    n = 1
    for x in ast.walk(node):
        n += isinstance(x, _BRANCHES)
        n += len(x.values) - 1 if isinstance(x, ast.BoolOp) else 0
        n += 1 + len(x.ifs) if isinstance(x, ast.comprehension) else 0
    return n


def cognitive(node: ast.AST, depth: int = 0) -> int:
    """Effort to follow: one per break of the flow and one more for each level it is nested in; an ``elif`` or ``else`` and a logical expression cost one flat."""
    n = 0
    for x in ast.iter_child_nodes(node):
        if isinstance(x, ast.If):
            n += 1 + depth + cognitive(ast.Module([ast.Expr(x.test), *x.body], []), depth + 1)
            rest = x.orelse
            while len(rest) == 1 and isinstance(rest[0], ast.If):
                n += 1 + cognitive(ast.Module([ast.Expr(rest[0].test), *rest[0].body], []), depth + 1)
                rest = rest[0].orelse
            n += (1 + cognitive(ast.Module(rest, []), depth + 1)) if rest else 0
        elif isinstance(x, _NESTING):
            n += 1 + depth + cognitive(x, depth + 1)
        else:
            n += isinstance(x, ast.BoolOp)
            n += cognitive(x, depth + isinstance(x, (*_Function.__args__, ast.Lambda)))
    return n


def telling_text(node: _Function, text: str) -> str:
    """What a function tells of itself: its head, its documentation and its comments, each line once, in order."""
    head = f"{node.name}({', '.join(a.arg for a in [*node.args.posonlyargs, *node.args.args, *node.args.kwonlyargs])})"
    lines = [head, *(ast.get_docstring(node) or "").splitlines()]
    try:
        lines += [t.string.lstrip("# ") for t in tokenize.generate_tokens(io.StringIO(text).readline) if t.type == tokenize.COMMENT]
    except (tokenize.TokenError, IndentationError):
        pass
    return "\n".join(dict.fromkeys(s for line in lines if (s := line.strip())))


def functions_of(source: str, least: int = 1) -> Iterator[tuple]:
    """The columns of FUNCTIONS after the id for each function of ``least`` lines or more, in order of their lines."""
    lines = source.splitlines()
    found = (x for x in ast.walk(ast.parse(source)) if isinstance(x, _Function))
    for x in sorted(found, key=lambda x: (x.lineno, x.col_offset)):
        start = min([x.lineno, *(d.lineno for d in x.decorator_list)])
        loc = x.end_lineno - start + 1
        if loc >= least:
            text = "\n".join(lines[start - 1 : x.end_lineno])
            yield x.name, start, x.end_lineno, loc, text, ast.dump(x), telling_text(x, text), hashlib.sha256(text.encode("utf-8", "replace")).hexdigest(), cyclomatic(x), cognitive(x)


def read_functions(spark: SparkSession, path: str, least: int = 1, pattern: str = "*.py") -> DataFrame:
    """Functions of all files under a path, FUNCTIONS; a file that doesn't parse yields none. Several folders are a union."""

    def rows_of(doc: str, data: bytes) -> list[tuple]:
        try:
            return [(doc, *r) for r in functions_of(data.decode("utf-8", "replace"), least)]
        except (SyntaxError, ValueError, RecursionError):
            return []

    return _per_file(_documents(spark, path, pattern), rows_of, FUNCTIONS)
