"""Dates, clean-up, selection and drift."""

import pytest
from pyspark.sql import functions as F

from recordloom.operators import transform

DATES = {
    "2023-01-02T03:04:05": ("2023-01-02", 0),
    "2023-01-02T03:04:05.000": (None, 1),
    "2023-01-02T03:04:05Z": (None, 1),
    "2023-01-02": (None, 1),
    "2023-13-02T00:00:00": (None, 1),
    "2023-02-30T00:00:00": (None, 1),
    " 2023-01-02T03:04:05": (None, 1),
    "junk": (None, 1),
    "": (None, 1),
    None: (None, 0),
}


def test_dates(spark):
    df = spark.createDataFrame([(d,) for d in DATES], "day string")
    parsed = transform.parse_dates(df, ["day"])
    assert parsed.columns == ["day", "day_parsed"]
    assert {r["day"]: r["day_parsed"] and str(r["day_parsed"]) for r in parsed.collect()} == {
        d: p for d, (p, _) in DATES.items()
    }
    failures = transform.count_date_failures(df, "day").first().asDict()
    assert failures == {"day_failures": sum(f for _, f in DATES.values())}
    assert transform.parse_dates(df, ["other"]).columns == ["day"]


def test_trim_cuts_spaces_only(spark):
    df = spark.createDataFrame([(1, " \t a \n "), (2, "  "), (3, None)], "n int, s string")
    assert [tuple(r) for r in transform.trim_strings(df).orderBy("n").collect()] == [
        (1, "\t a \n"),
        (2, ""),
        (3, None),
    ]


def test_drop_missing(spark):
    data = [("a", 1.0), ("", 2.0), ("  ", 3.0), (None, 4.0), ("b", None), ("c", float("nan"))]
    df = spark.createDataFrame(data, "s string, x double")
    kept = transform.clean(df, ["s", "x"]).collect()
    assert sorted(tuple(r) for r in kept) == [("", 2.0), ("", 3.0), ("a", 1.0)]
    with pytest.raises(ValueError, match="nope"):
        transform.drop_missing(df, ["s", "nope"])


def test_selection_and_drift(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    allowed = ["b", "zz", "a", "B"]
    selected = transform.select_allowed_columns(df, allowed)
    assert selected.columns == ["b", "a"]
    drift = transform.column_drift(spark, df.columns, allowed).collect()
    assert {tuple(r) for r in drift} == {("c", "dropped"), ("B", "missing"), ("zz", "missing")}
    assert len(drift) == 3
    assert transform.select_allowed_columns(df, ["a", "b", "a"]).columns == ["a", "b", "a"]
    with pytest.raises(ValueError):
        transform.select_allowed_columns(df, ["zz"])


def test_transformations_run_on_a_stream(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(" a ", "2023-01-02T03:04:05"), (None, "x")], "s string, d string").write.parquet(source)
    stream = spark.readStream.schema("s string, d string").parquet(source)
    cleaned = transform.clean(transform.parse_dates(stream, ["d"]), ["s"])
    query = (
        cleaned.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    rows = spark.read.parquet(out).select("s", F.col("d_parsed").cast("string")).collect()
    assert [tuple(r) for r in rows] == [("a", "2023-01-02")]
