"""Metadata to schema."""

import random
import sys

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions import names
from recordloom.operators.schema import build_schema, clean_field_name, data_type, dedup_names

METADATA = [
    ({"fieldName": ":id", "dataTypeName": "meta_data"}, "_id", T.StringType()),
    ({"fieldName": "vin_1_10", "dataTypeName": "text"}, "vin_1_10", T.StringType()),
    ({"fieldName": "electric_range", "dataTypeName": "Number"}, "electric_range", T.DoubleType()),
    ({"fieldName": "active", "dataTypeName": "checkbox"}, "active", T.BooleanType()),
    ({"dataTypeName": "text"}, "col_4", T.StringType()),
    ({"fieldName": "a b"}, "a_b", T.StringType()),
    ({"fieldName": "a-b", "dataTypeName": "text"}, "a_b_1", T.StringType()),
    ({"fieldName": "a_b_1", "dataTypeName": "text"}, "a_b_1_1", T.StringType()),
    ({"fieldName": "expected_date", "dataTypeName": "calendar_date"}, "expected_date", T.StringType()),
    ({"fieldName": "straße", "dataTypeName": "point"}, "straße", T.StringType()),
    ({"fieldName": "Active", "dataTypeName": ""}, "Active_1", T.StringType()),
    ({"fieldName": "", "dataTypeName": None}, "col_11", T.StringType()),
    ({"fieldName": "a b"}, "a_b_2", T.StringType()),
]


def test_schema():
    schema = build_schema(m for m, _, _ in METADATA)
    assert schema == T.StructType([T.StructField(n, t, True) for _, n, t in METADATA])


def test_case_sensitive_names():
    assert build_schema([{"fieldName": "a"}, {"fieldName": "A"}], True).names == ["a", "A"]


def test_no_columns_is_an_error():
    with pytest.raises(ValueError):
        build_schema([])


def test_relational_forms_agree(spark):
    rows = [(i, m.get("fieldName"), m.get("dataTypeName")) for i, (m, _, _) in enumerate(METADATA)]
    df = spark.createDataFrame(rows, "i int, name string, type string")
    found = df.select(
        "*",
        names.sql_type(F.col("type")).alias("sql"),
        names.clean_name(names.name_or_default(F.col("name"), F.col("i"))).alias("clean"),
    )
    for row in found.collect():
        assert row["sql"] == data_type(row["type"]).simpleString()
        assert row["clean"] == clean_field_name(row["name"], row["i"])


@pytest.mark.parametrize("span", [1, 7, 100_000])
def test_numbering_of_a_hot_name(spark, span):
    data = [(i, "hot" if i % 3 else None if i % 2 else f"n{i % 5}") for i in range(200)]
    df = spark.createDataFrame(data, "i int, name string").repartition(5)
    found = {r["i"]: r["out"] for r in dedup_names(df, "name", "i", "out", span).collect()}
    seen, expected = {}, {}
    for i, name in data:
        n = seen.get(name, 0)
        seen[name] = n + 1
        expected[i] = None if name is None else f"{name}_{n}" if n else name
    assert found == expected


def test_names_are_unique_as_in_a_schema(spark):
    rng = random.Random(5)
    stems = ["a", "A", "b", "a_1", "a_1_1", "A_2", "b_1", "x_y", "hot", "hot", "hot"]
    lists = [["a", "a", "a_1", "A"], [rng.choice(stems) + rng.choice(["", "", "_1", "_2"]) for _ in range(300)]]
    for names_in in lists:
        rows = [(i, n, -i, "x") for i, n in enumerate(names_in)]
        df = spark.createDataFrame(rows, "at int, name string, stretch int, _size string").repartition(4)
        out = dedup_names(df, "name", "at", "out", span=10)
        assert out.columns == ["at", "name", "stretch", "_size", "out"]
        expected = build_schema([{"fieldName": n} for n in names_in]).names
        assert [r["out"] for r in out.orderBy("at").collect()] == expected
        assert len({n.lower() for n in expected}) == len(expected)


@pytest.mark.parametrize("seed", range(3))
def test_names_with_taken_numbers_are_unique_as_in_a_schema(spark, seed):
    rng = random.Random(seed)
    numbers = ["", "", "", "_1", "_2", "_3", "_7", "_01", "_0", "_1_1", "_2_1", "_1_1_1", "_1_01", "_99999999999999999999"]
    names_in = [rng.choice("aAb") + rng.choice(numbers[: 8 if seed else None]) for _ in range(250)]
    names_in += [f"c_{n}" for n in rng.sample(range(1, 60), 40)] + ["c"] * 30 + [f"c_{n}" for n in range(1, 80)]
    df = spark.createDataFrame(list(enumerate(names_in)), "at int, name string").repartition(4)
    found = [r["out"] for r in dedup_names(df, "name", "at", "out", span=10).orderBy("at").collect()]
    assert found == build_schema([{"fieldName": n} for n in names_in]).names


def test_rows_of_a_name_with_a_collision_go_to_many_tasks(spark):
    df = spark.range(40_000).select(F.col("id").alias("at"), F.when(F.col("id") == 7, "a_1").otherwise("a").alias("name"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # which puts small partitions into one task
    try:
        out = dedup_names(df, "name", "at", "out", span=500)
        tasks = out.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert len(tasks) > 4 and max(r["count"] for r in tasks) < 20_000
    assert out.select("out").distinct().count() == 40_000


def test_every_character_is_cleaned_as_by_the_schema_builder(spark):
    """All code points, in names of 64, each beside a letter beyond ASCII."""
    codes = [c for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    texts = ["é" + "".join(map(chr, codes[at : at + 64])) for at in range(0, len(codes), 64)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, name string").repartition(8)
    found = {r.i: r.name for r in rows.select("i", names.clean_name(F.col("name")).alias("name")).collect()}
    wrong = [i for i, text in enumerate(texts) if found[i] != clean_field_name(text, 0)]
    assert not wrong
    plain = spark.createDataFrame([("".join(map(chr, range(1, 128))),), (None,), ("",)], "name string")
    cleaned = [r.name for r in plain.select(names.clean_name(F.col("name")).alias("name")).collect()]
    assert cleaned == [clean_field_name("".join(map(chr, range(1, 128))), 0), None, ""]
