"""Rule sets: JSON documents on the driver, turned into small tables."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a rule file; rules are written by people.
MOST_BYTES = 4 << 20


def read_rules(path: str) -> dict[str, Any]:
    """A rule document without its comment entries (keys that begin with ``_``). A missing file raises FileNotFoundError."""
    with open(path, encoding="utf-8") as f:
        text = f.read(MOST_BYTES + 1)
    if len(text) > MOST_BYTES:
        raise ValueError(f"a rule file may have {MOST_BYTES} characters at most")
    return without_comments(json.loads(text))


def without_comments(value: Any) -> Any:
    if isinstance(value, dict):
        return {k: without_comments(v) for k, v in value.items() if not k.startswith("_")}
    return [without_comments(v) for v in value] if isinstance(value, list) else value


def overlay(base: Mapping[str, Any], over: Mapping[str, Any]) -> dict[str, Any]:
    """``base`` with the entries of ``over``: objects merge entry by entry, anything else replaces."""
    out = dict(base)
    for k, v in over.items():
        out[k] = overlay(out[k], v) if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else v
    return out


def require(rules: Mapping[str, Any], keys: tuple[str, ...], what: str) -> Mapping[str, Any]:
    """The rules if they have all keys; a ValueError that names the missing ones otherwise."""
    missing = [k for k in keys if k not in rules]
    if missing:
        raise ValueError(f"{what} lacks {', '.join(missing)}")
    return rules


def _rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def field_table(spark: SparkSession, sheets: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """``sheets``: sheet to ``{"fields": {field: {type, section, row, label, unit, sign, is_total, no_scaling}}}``. Order of the document is kept as rule_ord."""
    rows = []
    for sheet, rules in sheets.items():
        for n, (field, r) in enumerate(require(rules, ("fields",), sheet)["fields"].items(), 1):
            rows.append((sheet, field, n, r.get("type", "int"), r.get("section"), r.get("row"), r.get("label", field), r.get("unit"), r.get("sign"), bool(r.get("is_total", False)), bool(r.get("no_scaling", False))))
    return _rows(spark, rows, "sheet string, field string, rule_ord int, value_type string, section string, row_no int, label string, unit string, sign string, is_total boolean, no_scaling boolean")


def keyword_table(spark: SparkSession, sheets: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """``sheets``: sheet to ``{"sections": {section: {field: {match, exclude, labels}}}}``."""
    rows, n = [], 0
    for sheet, rules in sheets.items():
        for section, fields in require(rules, ("sections",), sheet)["sections"].items():
            for field, r in fields.items():
                n += 1
                rows.append((sheet, section, field, n, list(r.get("match", [])), list(r.get("exclude", [])), list(r.get("labels", []))))
    return _rows(spark, rows, "sheet string, section string, field string, rule_ord int, match_words array<string>, exclude_words array<string>, labels array<string>")


def sum_table(spark: SparkSession, rules: list[Mapping[str, Any]], tolerance: float = 1.0) -> DataFrame:
    """``[{description, total_field, sum_fields, tolerance}]`` as the (rule, field) rows that sum_check takes."""
    rows = []
    for r in rules:
        own = float(r.get("tolerance", tolerance))
        rows += [(r["description"], f, False, own) for f in r["sum_fields"]] + [(r["description"], r["total_field"], True, own)]
    return _rows(spark, rows, "rule string, field string, is_total boolean, tolerance double")


def rule_at(rules: Mapping[str, Any], path: str, default: Any = None) -> Any:
    """The entry at a dotted path, such as ``validation.sums``; the default where a step is absent."""
    at: Any = rules
    for step in path.split("."):
        if not isinstance(at, Mapping) or step not in at:
            return default
        at = at[step]
    return at


def field_names(rules: Mapping[str, Any], path: str = "fields") -> list[str]:
    """The names of the fields listed at a path, in the document's order."""
    return list(rule_at(rules, path, {}))


def section_labels(rules: Mapping[str, Any], section: str) -> list[str]:
    """All labels of a section's fields, in order."""
    return [x for r in rule_at(rules, f"sections.{section}", {}).values() for x in r.get("labels", [])]


def name_table(spark: SparkSession, names: Mapping[str, str]) -> DataFrame:
    """``(name, target)`` of a mapping such as field to result key or section to total; comment entries are left out."""
    return _rows(spark, [(k, v) for k, v in names.items() if not k.startswith("_")], "name string, target string")


def formula_table(spark: SparkSession, rules: list[Mapping[str, Any]], tolerance: float = 1.0) -> DataFrame:
    """``[{description, formula, tolerance}]`` as ``(rule, formula, tolerance)``."""
    return _rows(spark, [(r["description"], r["formula"], float(r.get("tolerance", tolerance))) for r in rules], "rule string, formula string, tolerance double")


def pair_table(spark: SparkSession, rules: list[Mapping[str, Any]], tolerance: float = 1.0) -> DataFrame:
    """``[{field_name, xbrl_key, display_name, tolerance}]`` as ``(rule, field, other, tolerance)``: which field of one source agrees with which of the other."""
    return _rows(spark, [(r.get("display_name", r["field_name"]), r["field_name"], r.get("xbrl_key", r["field_name"]), float(r.get("tolerance", tolerance))) for r in rules], "rule string, field string, other string, tolerance double")


# What total rows are called unless rules say otherwise.
TOTAL_MARKERS = ("Totales", "Total")


def total_markers(rules: Mapping[str, Any]) -> list[str]:
    return list(rule_at(rules, "total_row_markers", TOTAL_MARKERS))
