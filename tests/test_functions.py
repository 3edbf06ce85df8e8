"""Unit vectors of the parsers, and of period and text functions."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyspan.functions import keys, numbers, periods, text, vectors


def test_parse_thousands(one):
    cases = {"30.294": 30294, "(30.294)": -30294, "1.234.567": 1234567, "12345": 12345, "0": 0, None: None, "": None, "  ": None, "abc": None, "-": None, ".": None, "MUS$ 30.294": 30294, "1,5": 15, "-30.294": -30294, "3-4": None, "(1) 5": -15}
    assert one(list(cases), numbers.parse_thousands) == list(cases.values())


def test_parse_locale_decimal(one):
    cases = {"19,5": (19.5, False), "64.057": (64057.0, True), "1.234,56": (1234.56, False), "123": (123.0, True), "-19,5": (-19.5, False), "-1.234": (-1234.0, True), "1.5": (1.5, False), "1.234.567": (1234567.0, True), "": None, None: None, "x": None, "1,2,3": None}
    assert [r and tuple(r) for r in one(list(cases), numbers.parse_locale_decimal)] == list(cases.values())


def test_parse_mixed_number(one):
    cases = {"1.234.567,89": 1234567.89, "1,234,567.89": 1234567.89, "1.234": 1.234, "1,234": 1.234, "(1.234,5)": -1234.5, "-": None, "abc": None, "$ 5": 5.0, "": None, None: None, "CLP 7": 7.0}
    assert one(list(cases), numbers.parse_mixed_number) == list(cases.values())


def test_current_value(one):
    cases = {
        "Producto A MUS$ 12.391 13.356": 12391.0, "Resultado MUS$ 6 5.483 4 3.742": 65483.0, "Costo US$ 3 ,57 3 ,43": 3.57, "Gasto 22 ( 126.202) (95.000)": -126202.0, "Gasto 8 5.000 4.000": 85000.0,
        "sin cifras": None, "": None, None: None, "nota 7": None,
    }
    assert one(list(cases), numbers.current_value) == list(cases.values())
    assert one(["a 1.000 2.000", "a 1.000"], lambda c: numbers.current_value(c, 1)) == [2000.0, 1000.0]
    assert one(["Gasto 8 5.000", "Gasto 8.000"], numbers.joins_lone_digit) == [True, False]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.integers(-(10**9), 10**9), min_size=1, max_size=20))
def test_thousands_round_trip(one, values):
    written = [f"({abs(v):,})".replace(",", ".") if v < 0 else f"{v:,}".replace(",", ".") for v in values]
    assert one(written, numbers.parse_thousands) == values


def test_scaling(one):
    assert one([-1500.0, 1500.0, None], numbers.scale_floor, "double") == [-2, 1, None]
    assert one([-1500.0, 1500.0, None], numbers.scale_trunc, "double") == [-1, 1, None]


def test_periods(spark, one):
    assert one([1, 4, 0, 5, None], periods.quarter_to_roman, "int") == ["I", "IV", None, None, None]
    assert one(["ii", " IV", "V", None, ""], periods.roman_to_quarter) == [2, 4, None, None, None]
    got = one(["2024_QII", "2024_QIV", "2024_Q3", "2024_M06", "2024_FY", "2024_Q5", "x", None], periods.parse_period)
    assert [r and tuple(r) for r in got] == [(2024, 2, "quarterly"), (2024, 4, "quarterly"), (2024, 3, "quarterly"), (2024, 6, "monthly"), (2024, 1, "yearly"), None, None, None]
    assert [tuple(r) for r in one(["2024_QII", "?"], periods.period_sort_key)] == [(2024, 2), (9999, 9)]
    row = spark.range(1).select(
        periods.format_period(F.lit(2024), F.lit(2)), periods.format_period(F.lit(2024), F.lit(2), style="display"), periods.format_period(F.lit(2024), F.lit(6), "monthly"),
        periods.format_period(F.lit(2024), F.lit(6), "monthly", "display"), periods.format_period(F.lit(2024), F.lit(1), "yearly"), periods.format_period(F.lit(2024), F.lit(2), "other"), periods.quarter_end(F.lit(2024), F.lit(3)),
    ).first()
    assert tuple(row) == ("2024_QII", "IIQ2024", "2024_M06", "06-2024", "2024_FY", "2024_Q2", "2024-09-30")


def test_keys(one):
    assert one(["SG-000000012", " sg 000000012", "SG12", "x", "", None], lambda c: keys.coded_id(c, "SG", 9)) == ["SG-000000012"] * 3 + [None] * 3
    assert one(["Cash_Cost", " cash-cost ", "CASH  COST", "", None], keys.field_name) == ["cash_cost"] * 3 + ["", None]
    spelled = ["2017_QII", "IIQ2017", "2017_Q2", "2017-Q2", "Q2 2017", "2017", None, "IVQ2017"]
    assert one(spelled, keys.period_year) == [2017] * 6 + [None, 2017]
    assert one(spelled, keys.period_quarter) == [2] * 5 + [None, None, 4]


def test_text(one):
    assert one(["Ácido; (Ñandú)  X", "", None], text.normalize_for_matching) == ["acido nandu x", "", None]
    assert one([" a  b\n", None, "   "], text.clean_text) == ["a b", None, ""]
    assert one(["  ", " x ", None], text.blank_to_null) == [None, "x", None]
    assert one(["ÁB", "ab"], text.text_variants) == [["áb", "ab"], ["ab"]]
    assert one(["reporte_eeff_ifrs"], text.format_sheet_name) == ["Reporte EEFF IFRS"]


@pytest.mark.parametrize("a,b,expected", [([1.0, 0.0], [1.0, 0.0], 1.0), ([1.0, 0.0], [0.0, 2.0], 0.0), ([0.0, 0.0], [1.0, 1.0], 0.0), ([1.0, 1.0], [1.0, 0.0], math.sqrt(0.5))])
def test_cosine(spark, a, b, expected):
    df = spark.createDataFrame([(a, b)], "a array<double>, b array<double>")
    assert df.select(vectors.cosine(F.col("a"), F.col("b"))).first()[0] == pytest.approx(expected)


def test_concat_unit(spark):
    df = spark.createDataFrame([([3.0], [4.0]), ([0.0], [0.0])], "a array<double>, b array<double>")
    assert [r[0] for r in df.select(vectors.concat_unit(F.col("a"), F.col("b"))).collect()] == [[0.6, 0.8], [0.0, 0.0]]
