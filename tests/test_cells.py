"""Coercion of cells and texts."""

import json
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recordloom.functions import cells
from recordloom.functions.cells import Cell

NAN = float("nan")
INF = float("inf")


def same(a, b):
    if isinstance(a, float) and isinstance(b, float) and math.isnan(b):
        return math.isnan(a)
    return type(a) is type(b) and a == b


def coerce(spark, convert, literals):
    """Convert JSON literals, as they come out of a record."""
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(literals)], "i int, t string")
    cell = Cell.of(F.col("cell"))
    parsed = rows.select("i", F.expr("try_variant_get(parse_json('[' || t || ']'), '$[0]', 'variant')").alias("cell"))
    return [r["v"] for r in parsed.select("i", convert(cell).alias("v")).orderBy("i").collect()]


def check(spark, convert, expected):
    found = coerce(spark, convert, expected)
    assert all(map(same, found, expected.values())), list(zip(expected.items(), found))


def test_numbers(spark):
    check(
        spark,
        cells.number_from_cell,
        {
            '"12.50"': 12.5, "7": 7.0, '" 12 "': 12.0, '"1e5"': 100000.0, '".5"': 0.5,
            '"12."': 12.0, '"1_000"': 1000.0, "true": 1.0, "false": 0.0, '"true"': None,
            '""': None, '"abc"': None, '"0x10"': None, '"2,000"': None, '"1d"': None,
            '"1f"': None, '"1__0"': None, '"_1"': None, '"0x1p3"': None, '"nan"': NAN,
            '"+nan"': NAN, '"-NaN"': NAN, '"-inf"': -INF, '"Infinity"': INF, '"1e400"': INF,
            '"\\t7\\n"': 7.0, '"\\u00a07"': 7.0, '"１２"': None, '{"a":1}': None, "[1]": None,
            "null": None, "100000000000000000000": 1e20, "5.0": 5.0, "1e22": 1e22,
        },
    )


def test_longs(spark):
    check(
        spark,
        cells.long_from_cell,
        {'"12.9"': 12, '"-12.9"': -12, "7.5": 7, "true": 1, '"nan"': None, '"inf"': None,
         '"x"': None, "null": None, '"1_0"': 10},
    )


def test_checkboxes(spark):
    check(
        spark,
        cells.checkbox_from_cell,
        {
            '"TRUE"': True, '"yes"': True, '"1"': True, '"t"': True, '"T"': True, "true": True,
            "2": True, "0.5": True, "-1": True, "[1]": True, "[null]": True, '{"a":null}': True,
            '" t"': False, '"maybe"': False, '""': False, '"no"': False, "false": False,
            "0": False, "0.0": False, "[]": False, "{}": False, "null": None,
        },
    )


def test_texts(spark):
    check(
        spark,
        cells.text_from_cell,
        {
            '"x"': "x", '""': "", "7": "7", "-7": "-7",
            "100000000000000000000": "100000000000000000000", "true": "True", "false": "False",
            "5.0": "5.0", "1.10": "1.1", "-3.0": "-3.0", "0.25": "0.25", "100.0": "100.0",
            "1e22": "1.0E22", '{"a":1,"b":[null,"x"]}': '{"a":1,"b":[null,"x"]}', "null": None,
            '"true"': "true", '"5.0"': "5.0",
        },
    )


def test_plain_fractions_and_integers_print_as_in_python(spark):
    values = [n / 4 for n in range(-40, 40)] + [123456.789, 0.001, 99999.5] + list(range(-5, 5))
    literals = {json.dumps(v): str(v) for v in values if str(v) != "-0.0"}
    check(spark, cells.text_from_cell, literals)


def expected_number(text):
    try:
        return float(text)
    except ValueError:
        return None


pieces = st.sampled_from(
    ["0", "1", "12", ".", "-", "+", "e", "E", "_", " ", "\t", "\n", "inf", "INFINITY", "nan", "NaN",
     "d", "f", "x", "0x", ",", " ", "\x1c", "\x00", "i", "ı"]
)
texts = st.lists(pieces, max_size=7).map("".join).filter(
    lambda t: t.isascii() or "\x1c" not in t
)
numbers = st.floats(allow_nan=False).map(repr)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(texts, numbers), min_size=400, max_size=400))
def test_numbers_agree_with_python(spark, samples):
    rows = spark.createDataFrame(list(enumerate(samples)), "i int, t string")
    found = rows.select("i", cells.number_from_text(F.col("t")).alias("v")).orderBy("i").collect()
    wrong = [
        (t, r["v"]) for t, r in zip(samples, found) if not same(r["v"], expected_number(t))
    ]
    assert not wrong


@pytest.mark.parametrize("convert", [cells.number_from_text, cells.checkbox_from_text])
def test_null_stays_null(spark, convert):
    assert spark.range(1).select(convert(F.lit(None).cast("string"))).first()[0] is None
