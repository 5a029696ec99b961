"""The registered queries, each beside the SQL it must agree with.

The test tables are clean, so most queries first put dirt into a table, by rules
on its key that the SQL repeats.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.functions import cells, names
from recordloom.operators import quality, records, transform
from recordloom.operators.schema import build_schema, dedup_names
from recordloom.plans.curation import Curation, run
from recordloom.plans.documents import COMPRESSION, documents_once, json_cells, writing_session
from recordloom.plans.profiles import VEHICLE_REGISTRATIONS
from recordloom.sinks.table import ensure_namespace, write_table
from recordloom.sources.admission import admission
from recordloom.sources.envelope import WHOLE_DOCUMENT_BYTES, Export, land
from recordloom.sources.reading import reading_session
from recordloom.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_rest(key: str, modulus: int, rests: dict[int, Column], otherwise: Column) -> Column:
    """The column for the remainder of ``key``, else ``otherwise``."""
    chosen = otherwise
    for rest, value in rests.items():
        chosen = F.when(F.col(key) % modulus == rest, value).otherwise(chosen)
    return chosen


def text_null() -> Column:
    return F.lit(None).cast("string")


# Sources

CUSTOMER_COLUMNS = [
    {"fieldName": ":id", "dataTypeName": "meta_data", "id": -1},
    {"fieldName": "name", "dataTypeName": "text"},
    {"fieldName": "Name", "dataTypeName": "text"},
    {"dataTypeName": "Number"},
    {"fieldName": "acct bal"},
]


def customer_documents(spark: SparkSession, sf_dir: str) -> str:
    customer = table(spark, sf_dir, "customer")
    rows = customer.select(
        json_cells(
            F.col("c_custkey"),
            F.concat(F.lit('["'), "c_name", F.lit('"]')),
            F.col("c_mktsegment"),
            F.col("c_nationkey"),
            F.col("c_acctbal").cast("string"),
        )
    )
    return documents_once(sf_dir, "customer", rows, CUSTOMER_COLUMNS)


CUSTOMER_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS _id, '["' || c_name || '"]' AS name,
       c_mktsegment AS "Name_1", CAST(c_nationkey AS DOUBLE) AS col_3,
       CAST(c_acctbal AS VARCHAR) AS acct_bal
FROM customer
"""


def customer_rows(export: Export) -> DataFrame:
    schema = build_schema(export.columns())
    return records.create_dataframe(export.records(), schema)


@query(CUSTOMER_SQL)
def envelope_rows(spark, sf_dir):
    """Documents read whole, schema built from their metadata, rows typed."""
    return customer_rows(Export.open(spark, customer_documents(spark, sf_dir)))


@query(CUSTOMER_SQL)
def envelope_rows_split(spark, sf_dir):
    """The same documents, each read by many tasks."""
    path = customer_documents(spark, sf_dir)
    return customer_rows(Export.open(spark, path, whole_document_bytes=0))


@query(CUSTOMER_SQL)
def landed_rows(spark, sf_dir):
    """The same documents, landed as untyped records and typed from there."""
    export = Export.open(spark, customer_documents(spark, sf_dir))
    landed = land(export, scratch_path(spark, "landed"))
    return records.create_dataframe(landed, build_schema(export.columns()))


@query(
    """
SELECT (row_number() OVER (ORDER BY n_nationkey) - 1)::INTEGER AS position,
       CASE WHEN n_nationkey % 7 <> 0 THEN n_name END AS field_name,
       CASE n_regionkey WHEN 0 THEN 'text' WHEN 1 THEN 'Number' WHEN 2 THEN 'checkbox' END AS type_name
FROM nation
"""
)
def envelope_columns(spark, sf_dir):
    """The column metadata of a document whose columns are the nations, from either reader."""
    kinds = {0: "text", 1: "Number", 2: "checkbox"}
    nations = table(spark, sf_dir, "nation").orderBy("n_nationkey").collect()  # 25 rows at any scale
    columns = []
    for nation in nations:
        entry = {"id": nation.n_nationkey}
        if nation.n_nationkey % 7:
            entry["fieldName"] = nation.n_name
        if nation.n_regionkey in kinds:
            entry["dataTypeName"] = kinds[nation.n_regionkey]
        columns.append(entry)
    rows = table(spark, sf_dir, "region").select(json_cells(F.col("r_regionkey"), F.col("r_name")))
    path = documents_once(sf_dir, "nations", rows, columns)
    read = [Export.open(spark, path, size) for size in (10**9, 0)]
    both = read[0].whole.select("meta").unionByName(read[1].split.skeletons.select("meta"))
    entry = F.posexplode("columns").alias("position", "entry")
    described = both.select(F.col("meta.view.columns").alias("columns")).distinct().select(entry)
    return described.select(
        "position",
        F.col("entry.fieldName").alias("field_name"),
        F.col("entry.dataTypeName").alias("type_name"),
    )


@query("SELECT o_orderkey::DOUBLE AS key, o_orderstatus AS status, o_totalprice AS price FROM orders")
def flat_rows_split(spark, sf_dir):
    """Documents without nested arrays, read in splits: every stretch but the ends is even."""
    columns = [{"fieldName": "key", "dataTypeName": "number"}, {"fieldName": "status"}, {"fieldName": "price", "dataTypeName": "number"}]
    rows = table(spark, sf_dir, "orders").select(
        json_cells(F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_totalprice").cast("string"))
    )
    path = documents_once(sf_dir, "orders", rows, columns)
    return customer_rows(Export.open(spark, path, whole_document_bytes=0))


ORDER_COLUMNS = [{"fieldName": "key", "dataTypeName": "number"}, {"fieldName": "status"}]


def order_documents(spark: SparkSession, sf_dir: str, label: str, edges) -> str:
    """The orders in eight documents by the remainder of their key, ``edges`` around them."""
    orders = table(spark, sf_dir, "orders")
    rows = orders.select(json_cells(F.col("o_orderkey"), F.col("o_orderstatus")), "o_orderkey")
    return documents_once(sf_dir, label, rows, ORDER_COLUMNS, "o_orderkey", "o_orderkey", documents=8, edges=edges)


def document_number() -> Column:
    return F.regexp_extract("source", r"document=([0-9]+)", 1).cast("int").alias("document")


def faulty(document: Column, before: Column, after: Column) -> tuple[Column, Column]:
    """Documents 1 to 6 have a fault each, 7 describes other columns."""
    opening = (
        F.when(document == 1, F.regexp_replace(before, '"meta": .*, "data"', '"meta": {}, "data"'))
        .when(document == 3, F.replace(before, F.lit('"data"'), F.lit('"rows"')))
        .when(document == 6, F.concat(F.replace(before, F.lit('"data": ['), F.lit('"data": {"list": ['))))
        .when(document == 7, F.replace(before, F.lit('"status"'), F.lit('"state"')))
        .otherwise(before)
    )
    closing = (
        F.when(document == 2, '], "d\\u0061ta": []}').when(document == 4, "]")
        .when(document == 5, "]}]").when(document == 6, "]}}").otherwise(after)
    )
    return opening, closing


@query(
    """
SELECT reader, document, CASE WHEN document IN (2, 3, 4, 5, 6) THEN 0 ELSE n END AS records,
       CASE document WHEN 1 THEN 'a document has no column metadata' WHEN 2 THEN 'a document has data twice'
            WHEN 3 THEN 'a document has no data' WHEN 4 THEN 'broken' WHEN 5 THEN 'broken'
            WHEN 6 THEN 'data is not a list' END AS fault,
       document = 0 AS loaded_with_first
FROM (SELECT (o_orderkey % 8)::INTEGER AS document, count(*) AS n FROM orders GROUP BY 1),
     (VALUES ('whole'), ('split')) AS r(reader)
"""
)
def admission_table(spark, sf_dir):
    """What either reader says of each document before any is loaded."""
    path = order_documents(spark, sf_dir, "faulty", faulty)
    fault = F.when(F.col("fault").rlike("too|one JSON|ends in"), "broken").otherwise(F.col("fault")).alias("fault")
    sides = []
    for reader, size in (("whole", 10**9), ("split", 0)):
        rows = admission(spark, path, size).select(F.lit(reader).alias("reader"), document_number(), "records", fault, "described")
        sides.append(rows)
    both = sides[0].unionByName(sides[1])
    good = both.where("document = 0").select("reader", F.col("described").alias("first"))  # a row for each reader
    same = (F.col("fault").isNull() & (F.col("described") == F.col("first"))).alias("loaded_with_first")
    return both.join(F.broadcast(good), "reader").select("reader", "document", "records", "fault", same)


@query(
    """
SELECT document, place - 1 AS position, '[' || o_orderkey || ',"' || o_orderstatus || '"]' AS record
FROM (SELECT *, (o_orderkey % 8)::INTEGER AS document,
             row_number() OVER (PARTITION BY o_orderkey % 8 ORDER BY o_orderkey, o_orderstatus) AS place FROM orders)
WHERE place <= 3 AND document <> 3
UNION ALL SELECT 3, NULL, NULL FROM (SELECT 1 FROM orders WHERE o_orderkey % 8 = 3 LIMIT 1)
"""
)
def first_records(spark, sf_dir):
    """The first three records of every document, from either reader; document 3 has none."""

    def without_records(document: Column, before: Column, after: Column) -> tuple[Column, Column]:
        none = F.replace(before, F.lit('"data": ['), F.lit('"data": [ ], "rows": ['))
        return F.when(document == 3, none).otherwise(before), after

    path = order_documents(spark, sf_dir, "firsts", without_records)
    read = [Export.open(spark, path, size).first_records(3) for size in (10**9, 0)]
    found = read[0].unionByName(read[1]).select(document_number(), "position", F.to_json("record").alias("record"))
    return found.distinct()


# Metadata to schema

TYPE_NAMES = ["number", "Number", "TEXT", "checkbox", "CheckBox", "calendar_date", ""]


@query(
    """
SELECT event_id, CASE event_id % 8 WHEN 0 THEN 'double' WHEN 1 THEN 'double'
                 WHEN 3 THEN 'boolean' WHEN 4 THEN 'boolean' ELSE 'string' END AS sql_type
FROM events
"""
)
def type_map(spark, sf_dir):
    named = by_rest("event_id", 8, {i: F.lit(t) for i, t in enumerate(TYPE_NAMES)}, text_null())
    return table(spark, sf_dir, "events").select(
        "event_id", names.sql_type(named).alias("sql_type")
    )


@query(
    """
SELECT page_id, CASE WHEN page_id % 5 IN (0, 1) THEN 'col_' || page_id ELSE url END AS name
FROM pages
"""
)
def name_default(spark, sf_dir):
    name = by_rest("page_id", 5, {0: text_null(), 1: F.lit("")}, F.col("url"))
    return table(spark, sf_dir, "pages").select(
        "page_id", names.name_or_default(name, F.col("page_id")).alias("name")
    )


@query("SELECT page_id, regexp_replace(url, '[^\\p{L}\\p{N}_]', '_', 'g') AS name FROM pages")
def name_clean(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", names.clean_name(F.col("url")).alias("name")
    )


# Letters and digits of several scripts, signs, a combining accent, and characters beyond 16 bits.
FOREIGN = ["straße", "日本語", "Ωmega²", "½ ٣ Ⅷ", "cafe\u0301", "a—b", "x\U0001d53ay\U0001f600", "naïve\u00a0é"]


@query(
    f"""
SELECT page_id, regexp_replace(url || (['{"','".join(FOREIGN)}'])[page_id % {len(FOREIGN)} + 1],
                               '[^\\p{{L}}\\p{{N}}_]', '_', 'g') AS name FROM pages
"""
)
def name_clean_foreign(spark, sf_dir):
    """Names with letters beyond ASCII."""
    foreign = F.element_at(F.array(*map(F.lit, FOREIGN)), (F.col("page_id") % len(FOREIGN) + 1).cast("int"))
    return table(spark, sf_dir, "pages").select("page_id", names.clean_name(F.concat("url", foreign)).alias("name"))


@query(
    """
WITH RECURSIVE hosts AS (
  SELECT row_number() OVER (ORDER BY page_id) AS i, page_id,
         CASE page_id % 5 WHEN 0 THEN 'a' WHEN 1 THEN 'A' WHEN 2 THEN 'a_1' WHEN 3 THEN 'a_1_1'
              ELSE split_part(url, '/', 3) END AS name
  FROM pages),
given AS (
  SELECT 0::BIGINT AS i, NULL::BIGINT AS page_id, NULL::VARCHAR AS name, []::VARCHAR[] AS used
  UNION ALL
  SELECT h.i, h.page_id, h.new, list_append(g.used, lower(h.new)) FROM given g, LATERAL (
    SELECT h.i, h.page_id,
           CASE WHEN NOT list_contains(g.used, lower(h.name)) THEN h.name
                ELSE h.name || '_' || list_min(list_filter(range(1, len(g.used) + 2),
                       lambda k: NOT list_contains(g.used, lower(h.name) || '_' || k))) END AS new
    FROM hosts h WHERE h.i = g.i + 1) h)
SELECT page_id, name FROM given WHERE i > 0
"""
)
def name_dedup(spark, sf_dir):
    """Names that collide with each other's numbers, and the hosts of pages, which only repeat."""
    host = F.split_part("url", F.lit("/"), F.lit(3))
    named = by_rest("page_id", 5, {0: F.lit("a"), 1: F.lit("A"), 2: F.lit("a_1"), 3: F.lit("a_1_1")}, host)
    rows = table(spark, sf_dir, "pages")
    return dedup_names(rows.select("page_id", named.alias("host")), "host", "page_id", "name").select("page_id", "name")


# Records to typed rows


@query(
    """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE o_orderkey % 7 NOT IN (0, 1)
"""
)
def arity_filter(spark, sf_dir):
    key, customer = (F.col(c).cast("string") for c in ("o_orderkey", "o_custkey"))
    row = by_rest(
        "o_orderkey",
        7,
        {0: F.array(key, customer), 1: F.array(key, key, key, key)},
        F.array(key, customer, F.col("o_orderstatus")),
    )
    kept = records.keep_arity(table(spark, sf_dir, "orders").select(row.alias("row")), "row", 3)
    return kept.select(
        F.col("row")[0].cast("bigint").alias("o_orderkey"),
        F.col("row")[1].cast("bigint").alias("o_custkey"),
        F.col("row")[2].alias("o_orderstatus"),
    )


def value_text() -> Column:
    value = F.col("value").cast("string")
    key = F.col("event_id").cast("string")
    return by_rest(
        "event_id",
        12,
        {
            0: F.concat(F.lit("  "), value, F.lit("\t")),
            1: F.lit("n/a"),
            2: F.lit(""),
            3: text_null(),
            4: F.concat(key, F.lit("_000")),
            5: F.concat(value, F.lit("d")),
            6: F.lit("0x10"),
            7: F.concat(key, F.lit("e2")),
            8: F.concat(F.lit("-"), value),
            9: F.lit(".5"),
        },
        value,
    )


@query(
    """
SELECT event_id, CASE WHEN event_id % 12 IN (1, 2, 3, 5, 6) THEN NULL
                      WHEN event_id % 12 = 4 THEN event_id * 1000.0::DOUBLE
                      WHEN event_id % 12 = 7 THEN event_id * 100.0::DOUBLE
                      WHEN event_id % 12 = 8 THEN -value
                      WHEN event_id % 12 = 9 THEN 0.5
                      ELSE value END AS number
FROM events
"""
)
def coerce_number(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", cells.number_from_text(value_text()).alias("number")
    )


@query(
    """
SELECT event_id, CASE WHEN event_id % 12 IN (1, 2, 3, 5, 6) THEN NULL
                      WHEN event_id % 12 = 4 THEN event_id * 1000
                      WHEN event_id % 12 = 7 THEN event_id * 100
                      WHEN event_id % 12 = 8 THEN CAST(trunc(-value) AS BIGINT)
                      WHEN event_id % 12 = 9 THEN 0
                      ELSE CAST(trunc(value) AS BIGINT) END AS number
FROM events
"""
)
def coerce_long(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", cells.long_from_text(value_text()).alias("number")
    )


@query(
    """
SELECT event_id, CASE event_id % 7 WHEN 0 THEN TRUE WHEN 1 THEN TRUE WHEN 2 THEN TRUE
                 WHEN 3 THEN TRUE WHEN 6 THEN NULL ELSE FALSE END AS ticked
FROM events
"""
)
def coerce_checkbox(spark, sf_dir):
    words = {0: "TRUE", 1: "yes", 2: "1", 3: "t", 4: " t", 5: "maybe"}
    word = by_rest("event_id", 7, {i: F.lit(w) for i, w in words.items()}, text_null())
    return table(spark, sf_dir, "events").select(
        "event_id", cells.checkbox_from_text(word).alias("ticked")
    )


def mixed_cells(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, cells.Cell]:
    """A JSON cell of another type for each remainder of the key."""
    key = F.col("event_id").cast("string")
    text = by_rest(
        "event_id",
        10,
        {
            0: key,
            1: F.concat(F.lit('"'), key, F.lit('"')),
            2: F.lit("true"),
            3: F.lit("null"),
            4: F.concat(key, F.lit(".0")),
            5: F.concat(key, F.lit(".25")),
            6: F.concat(F.lit("["), key, F.lit(", null]")),
            7: F.concat(F.lit('{"b": 1, "a": "'), "event_type", F.lit('"}')),
            8: F.lit("{}"),
        },
        F.lit("false"),
    )
    events = table(spark, sf_dir, "events")
    parsed = events.select("event_id", F.try_parse_json(text).alias("cell"))
    return parsed, cells.Cell.of(F.col("cell"))


@query(
    """
SELECT event_id, CASE event_id % 10 WHEN 0 THEN '' || event_id WHEN 1 THEN '' || event_id
    WHEN 2 THEN 'True' WHEN 3 THEN NULL WHEN 4 THEN event_id || '.0'
    WHEN 5 THEN event_id || '.25' WHEN 6 THEN '[' || event_id || ',null]'
    WHEN 7 THEN '{"a":"' || event_type || '","b":1}' WHEN 8 THEN '{}' ELSE 'False' END AS cell
FROM events
"""
)
def coerce_text(spark, sf_dir):
    parsed, cell = mixed_cells(spark, sf_dir)
    return parsed.select("event_id", cells.text_from_cell(cell).alias("cell"))


@query(
    """
SELECT event_id,
       CASE WHEN event_id % 10 IN (0, 1, 4) THEN CAST(event_id AS DOUBLE)
            WHEN event_id % 10 = 2 THEN 1 WHEN event_id % 10 = 9 THEN 0
            WHEN event_id % 10 = 5 THEN event_id + 0.25::DOUBLE END AS number,
       CASE WHEN event_id % 10 = 3 THEN NULL WHEN event_id % 10 IN (0, 4) THEN event_id <> 0
            WHEN event_id % 10 = 1 THEN event_id = 1
            ELSE event_id % 10 IN (2, 5, 6, 7) END AS ticked
FROM events
"""
)
def coerce_cells(spark, sf_dir):
    """Numbers and checkboxes from cells of every JSON type."""
    parsed, cell = mixed_cells(spark, sf_dir)
    return parsed.select(
        "event_id",
        cells.number_from_cell(cell).alias("number"),
        cells.checkbox_from_cell(cell).alias("ticked"),
    )


# Transformations


def dated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = by_rest(
        "event_id",
        10,
        {
            0: F.lit("junk"),
            1: text_null(),
            2: F.date_format("ts", "yyyy-MM-dd"),
            3: F.concat(F.lit(" "), good),
            4: F.concat(good, F.lit("Z")),
            5: F.concat(good, F.lit(".000")),
            6: F.lit("2023-02-30T00:00:00"),
            7: F.lit(""),
        },
        good,
    )
    return table(spark, sf_dir, "events").select("event_id", text.alias("ts_text"))


@query(
    """
SELECT event_id, CASE WHEN event_id % 10 IN (8, 9) THEN strftime(ts, '%Y-%m-%d') END
       AS ts_text_parsed
FROM events
"""
)
def date_parse(spark, sf_dir):
    dated = transform.parse_dates(dated_events(spark, sf_dir), ["ts_text", "no_such_column"])
    return dated.select("event_id", F.col("ts_text_parsed").cast("string").alias("ts_text_parsed"))


@query(
    """
SELECT count(CASE WHEN event_id % 10 NOT IN (1, 8, 9) THEN 1 END) AS ts_text_failures FROM events
"""
)
def date_failures(spark, sf_dir):
    return transform.count_date_failures(dated_events(spark, sf_dir), "ts_text")


@query(
    """
SELECT c_custkey, c_name || chr(9) AS c_name, c_mktsegment FROM customer
"""
)
def trim_strings(spark, sf_dir):
    padded = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lit("  "), "c_name", F.lit("\t ")).alias("c_name"),
        F.concat("c_mktsegment", F.lit(" ")).alias("c_mktsegment"),
    )
    return transform.trim_strings(padded)


def holey_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 5 != 0, F.col("o_custkey")).alias("o_custkey"),
        F.when(key % 17 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
    )


HOLEY_ORDERS = """
(SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS o_custkey,
        CASE WHEN o_orderkey % 17 <> 0 THEN o_orderstatus END AS o_orderstatus,
        o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders)
"""


@query(
    f"SELECT * FROM {HOLEY_ORDERS} WHERE o_custkey IS NOT NULL AND o_orderstatus IS NOT NULL"
)
def drop_missing_ids(spark, sf_dir):
    return transform.clean(holey_orders(spark, sf_dir), ["o_custkey", "o_orderstatus"])


@query("SELECT c_mktsegment, c_custkey, c_name FROM customer")
def select_allowed(spark, sf_dir):
    allowed = ["c_mktsegment", "c_custkey", "no_such_column", "c_name", "C_ACCTBAL"]
    return transform.select_allowed_columns(table(spark, sf_dir, "customer"), allowed)


@query(
    """
WITH found AS (SELECT DISTINCT event_type || '_' || user_id AS name FROM events),
     allowed AS (SELECT DISTINCT 'click_' || c_custkey AS name FROM customer)
SELECT name AS "column", 'dropped' AS status FROM found WHERE name NOT IN (SELECT * FROM allowed)
UNION ALL
SELECT name, 'missing' FROM allowed WHERE name NOT IN (SELECT * FROM found)
"""
)
def column_drift(spark, sf_dir):
    """Names that occur in one table against the names that another allows."""
    found = table(spark, sf_dir, "events").select(F.concat_ws("_", "event_type", "user_id"))
    allowed = table(spark, sf_dir, "customer").select(F.concat(F.lit("click_"), "c_custkey"))
    return transform.name_drift(found, allowed)


# Quality checks


@query(
    f"""
SELECT count(CASE WHEN o_custkey IS NULL THEN 1 END) AS o_custkey_nulls,
       count(CASE WHEN o_orderstatus IS NULL THEN 1 END) AS o_orderstatus_nulls
FROM {HOLEY_ORDERS}
"""
)
def null_audit(spark, sf_dir):
    return holey_orders(spark, sf_dir).agg(*quality.null_counts(["o_custkey", "o_orderstatus"]))


DUPLICATES_SQL = """
count(*) AS total_rows,
       count(DISTINCT o_custkey) + max(CASE WHEN o_custkey IS NULL THEN 1 ELSE 0 END)
           AS distinct_o_custkey,
       count(*) <> count(DISTINCT o_custkey) + max(CASE WHEN o_custkey IS NULL THEN 1 ELSE 0 END)
           AS has_duplicates
"""


@query(f"SELECT {DUPLICATES_SQL} FROM {HOLEY_ORDERS}")
def dup_audit(spark, sf_dir):
    return holey_orders(spark, sf_dir).agg(*quality.duplicate_counts("o_custkey"))


@query(
    f"SELECT o_custkey, count(*) AS count FROM {HOLEY_ORDERS} GROUP BY o_custkey HAVING count(*) > 1"
)
def dup_keys(spark, sf_dir):
    return quality.duplicate_keys(holey_orders(spark, sf_dir), "o_custkey")


@query(
    f"SELECT min(o_orderdate) AS min_date, max(o_orderdate) AS max_date FROM {HOLEY_ORDERS}"
)
def range_audit(spark, sf_dir):
    return holey_orders(spark, sf_dir).agg(*quality.value_range("o_orderdate", "date"))


@query(
    f"""
SELECT count(CASE WHEN o_custkey IS NULL THEN 1 END) AS o_custkey_nulls,
       count(CASE WHEN o_orderstatus IS NULL THEN 1 END) AS o_orderstatus_nulls, {DUPLICATES_SQL},
       min(o_totalprice) AS min_price, max(o_totalprice) AS max_price,
       count(CASE WHEN o_orderkey % 4 IN (0, 1) THEN 1 END) AS o_orderdate_failures
FROM {HOLEY_ORDERS}
"""
)
def full_audit(spark, sf_dir):
    """All checks in one aggregate; some dates parse, some do not, some are missing."""
    text = F.col("o_orderdate")
    dates = by_rest("o_orderkey", 4, {0: F.lit("junk"), 1: text, 2: text_null()}, F.concat(text, F.lit("T00:00:00")))
    return quality.quality_report(
        holey_orders(spark, sf_dir).withColumn("o_orderdate", dates),
        keys=["o_custkey", "o_orderstatus"],
        unique="o_custkey",
        ranges={"o_totalprice": "price"},
        dates=["o_orderdate", "no_such_column"],
    )


@query(
    f"""
SELECT count(*) AS batches, sum(n)::BIGINT AS rows, sum(nulls)::BIGINT AS nulls, TRUE AS within,
       (SELECT CASE WHEN count(*) - count(o_custkey) > 1 THEN TRUE END FROM {HOLEY_ORDERS}) AS has_duplicates
FROM (SELECT left(o_orderdate, 4) AS year, count(*) AS n, count(*) - count(o_custkey) AS nulls
      FROM {HOLEY_ORDERS} GROUP BY year)
"""
)
def merged_distinct(spark, sf_dir):
    """Sketches of a column, one kept for each year, merged: whether the exact count lies within their bounds."""
    orders = holey_orders(spark, sf_dir).withColumn("year", F.left("o_orderdate", F.lit(4)))
    batches = quality.distinct_sketch(orders, "o_custkey", ["year"])
    bounds = quality.sketch_bounds(quality.merged_sketches(batches))
    exact = orders.agg(quality.distinct_with_null("o_custkey").alias("exact"))
    counted = batches.agg(F.count(F.lit(1)).alias("batches"))
    within = F.col("exact").between(F.col("at_least"), F.col("at_most")).alias("within")
    # three tables of one row each
    return bounds.join(exact, F.lit(True)).join(counted, F.lit(True)).select("batches", "rows", "nulls", within, "has_duplicates")


# Sinks


def query_namespace(spark: SparkSession) -> str:
    """A namespace of its own for a query's table, in the shared folder."""
    namespace = f"recordloom_{uuid.uuid4().hex}"
    ensure_namespace(spark, "spark_catalog", namespace, scratch_path(spark, "tables"))
    return namespace


@query(f"SELECT * FROM {HOLEY_ORDERS} WHERE o_custkey IS NOT NULL")
def curated_table(spark, sf_dir):
    """A table written, replaced by another one, and read back."""
    namespace = query_namespace(spark)
    orders = holey_orders(spark, sf_dir)
    write_table(orders.select("o_custkey"), "spark_catalog", namespace, "orders", fmt="parquet")
    kept = transform.clean(orders, ["o_custkey"])
    return spark.table(write_table(kept, "spark_catalog", namespace, "orders", fmt="parquet"))


@query(
    f"""
SELECT * FROM {HOLEY_ORDERS} WHERE o_custkey IS NOT NULL
UNION ALL SELECT * FROM {HOLEY_ORDERS} WHERE o_orderstatus IS NOT NULL
"""
)
def appended_table(spark, sf_dir):
    """A table written and added to."""
    namespace = query_namespace(spark)
    orders = holey_orders(spark, sf_dir)
    for required, mode in (("o_custkey", "overwrite"), ("o_orderstatus", "append")):
        kept = transform.clean(orders, [required])
        name = write_table(kept, "spark_catalog", namespace, "orders", mode, "parquet")
    return spark.table(name)


# The whole run

REGISTRATION_COLUMNS = [
    {"fieldName": ":sid", "dataTypeName": "meta_data"},
    {"fieldName": "vin_1_10", "dataTypeName": "text"},
    {"fieldName": "county", "dataTypeName": "text"},
    {"fieldName": "city", "dataTypeName": "text"},
    {"fieldName": "state", "dataTypeName": "text"},
    {"fieldName": "zip code", "dataTypeName": "text"},
    {"fieldName": "model_year", "dataTypeName": "Number"},
    {"fieldName": "make", "dataTypeName": "text"},
    {"fieldName": "model", "dataTypeName": "text"},
    {"fieldName": "ev_type", "dataTypeName": "list"},
    {"fieldName": "cafv_type", "dataTypeName": "checkbox"},
    {"fieldName": "electric_range", "dataTypeName": "number"},
    {"fieldName": "base_msrp", "dataTypeName": "number"},
    {"fieldName": "legislative_district", "dataTypeName": "NUMBER"},
    {"fieldName": "dol_vehicle_id", "dataTypeName": "text"},
    {"fieldName": "geocoded_column", "dataTypeName": "point"},
    {"fieldName": "electric_utility", "dataTypeName": "text"},
    {"fieldName": "expected_date", "dataTypeName": "calendar_date"},
    {"fieldName": "", "dataTypeName": "text"},
    {"fieldName": "make", "dataTypeName": "text"},
]

REGISTRATIONS = replace(
    VEHICLE_REGISTRATIONS, allowed=(*VEHICLE_REGISTRATIONS.allowed, "expected_date_parsed", "lost")
)


def registration_records(lines: DataFrame) -> DataFrame:
    """One dirty registration record per line item; ``n`` numbers the line items."""
    lines = lines.withColumn("n", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    n = F.col("n")
    n_text = n.cast("string")
    date = F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss")
    no_cell = F.lit(None).cast("variant")

    def variant(value) -> Column:
        return (value if isinstance(value, Column) else F.lit(value)).cast("variant")

    year = (2000 + n % 30).cast("string")
    row = [
        F.concat(F.lit("row-"), n_text),
        F.when(n % 17 != 0, F.concat(F.lit("  V"), n_text, F.lit(" "))),
        F.concat(F.lit(" "), "l_returnflag", F.lit("\t ")),
        F.concat("l_linestatus", F.lit(']"')),
        by_rest("n", 5, {0: variant(True)}, variant("WA")),
        F.col("l_suppkey"),
        F.when(n % 11 == 0, variant("n/a"))
        .when(n % 7 == 0, variant(F.concat(F.lit(" "), year, F.lit(" "))))
        .when(n % 13 == 0, variant(F.concat_ws("_", F.left(year, F.lit(1)), F.right(year, F.lit(3)))))
        .otherwise(variant(2000 + n % 30)),
        F.concat(F.lit("make-"), F.col("l_partkey") % 50),
        F.when(n % 29 == 0, no_cell)
        .when(n % 31 == 0, variant(F.col("l_quantity")))
        .otherwise(variant(F.concat(F.lit("model-"), F.col("l_partkey")))),
        F.array(F.col("l_linenumber").cast("string"), F.lit("x]")),
        by_rest(
            "n",
            6,
            {0: variant("TRUE"), 1: variant("yes"), 2: variant(0), 3: variant(True), 4: variant(" t")},
            no_cell,
        ),
        F.col("l_quantity"),
        F.when(n % 37 == 0, F.lit("12d")).otherwise(F.col("l_extendedprice").cast("string")),
        F.when(n % 3 == 0, variant(True)).otherwise(variant(n % 49)),
        F.when(
            n % 19 != 0,
            F.concat(
                F.lit("D"), F.col("l_orderkey") * 10 + F.floor(F.col("l_linenumber") / F.lit(2))
            ),
        ),
        F.to_variant_object(
            F.struct(F.lit("Point").alias("type"), F.array("l_partkey", "l_suppkey").alias("at"))
        ),
        F.lit("utility"),
        by_rest("n", 41, {0: F.lit("junk"), 1: text_null(), 2: F.concat(F.lit(" "), date)}, date),
        F.lit("unnamed"),
        F.lit("second"),
    ]
    record = (
        F.when(n % 53 == 0, json_cells(*row[:3]))
        .when(n % 59 == 0, json_cells(*row, F.lit("extra")))
        .when(n % 61 == 0, F.lit("null"))
        .when(n % 67 == 0, F.concat(F.lit('{"n": '), n_text, F.lit("}")))
        .otherwise(json_cells(*row))
    )
    return lines.select(record.alias("record"), "n", "document")


def registration_documents(spark: SparkSession, sf_dir: str) -> str:
    """Compressed documents of the line items' registration records."""
    lines = table(writing_session(spark), sf_dir, "lineitem")
    layout = {"deal": "l_orderkey", "place": "n", "made": registration_records, "compression": COMPRESSION}
    return documents_once(sf_dir, "registrations", lines, REGISTRATION_COLUMNS, **layout)


# The text is some 8 times as large as the documents, where a reader counts on 32 times: up to 32 MB of it are read whole.
REGISTRATION_BYTES = WHOLE_DOCUMENT_BYTES * 4
# Of a document of full length this makes three splits.
SPLIT_BYTES = 1 << 20


def registrations(spark: SparkSession, sf_dir: str) -> Curation:
    own = registration_session(spark)
    return run(own, registration_documents(spark, sf_dir), REGISTRATIONS, whole_document_bytes=REGISTRATION_BYTES)


def registrations_in_splits(spark: SparkSession, sf_dir: str) -> Curation:
    """The same from documents that are each read by many tasks."""
    own = registration_session(spark)
    own.conf.set("spark.sql.files.maxPartitionBytes", str(SPLIT_BYTES))
    return run(own, registration_documents(spark, sf_dir), REGISTRATIONS, whole_document_bytes=0)


def registration_session(spark: SparkSession) -> SparkSession:
    """A session whose tables are smaller than by Spark's own default."""
    own = reading_session(spark)
    own.conf.set("spark.sql.parquet.compression.codec", "zstd")
    return own


REGISTRATION_SQL = """
(SELECT n, CASE WHEN n % 17 <> 0 THEN 'V' || n END AS vin_1_10, l_returnflag || chr(9) AS county,
        l_linestatus || ']"' AS city, CASE WHEN n % 5 = 0 THEN 'True' ELSE 'WA' END AS state,
        CAST(l_suppkey AS VARCHAR) AS zip_code,
        CASE WHEN n % 11 <> 0 THEN CAST(2000 + n % 30 AS DOUBLE) END AS model_year,
        'make-' || (l_partkey % 50) AS make,
        CASE WHEN n % 29 = 0 THEN NULL
             WHEN n % 31 = 0 THEN CAST(l_quantity AS VARCHAR)
             ELSE 'model-' || l_partkey END AS model,
        '["' || l_linenumber || '","x]"]' AS ev_type,
        CASE n % 6 WHEN 0 THEN TRUE WHEN 1 THEN TRUE WHEN 3 THEN TRUE WHEN 5 THEN NULL
             ELSE FALSE END AS cafv_type,
        l_quantity AS electric_range,
        CASE WHEN n % 37 <> 0 THEN l_extendedprice END AS base_msrp,
        CASE WHEN n % 3 = 0 THEN 1 ELSE CAST(n % 49 AS DOUBLE) END AS legislative_district,
        CASE WHEN n % 19 <> 0 THEN 'D' || (l_orderkey * 10 + l_linenumber // 2) END
            AS dol_vehicle_id,
        '{"at":[' || l_partkey || ',' || l_suppkey || '],"type":"Point"}' AS geocoded_column,
        'utility' AS electric_utility,
        CASE WHEN n % 41 NOT IN (0, 1, 2) THEN strftime(l_shipdate, '%Y-%m-%d') END
            AS expected_date_parsed
 FROM (SELECT *, l_orderkey * 10 + l_linenumber AS n FROM lineitem)
 WHERE n % 53 <> 0 AND n % 59 <> 0 AND n % 61 <> 0 AND n % 67 <> 0)
"""


CURATED_SQL = f"""
SELECT * EXCLUDE (n) FROM {REGISTRATION_SQL}
WHERE vin_1_10 IS NOT NULL AND dol_vehicle_id IS NOT NULL
"""


def dates_as_text(rows: DataFrame) -> DataFrame:
    return rows.withColumn("expected_date_parsed", F.col("expected_date_parsed").cast("string"))


@query(CURATED_SQL)
def curation_run(spark, sf_dir):
    """Documents to curated rows."""
    return dates_as_text(registrations(spark, sf_dir).curated)


@query(CURATED_SQL)
def curation_run_split(spark, sf_dir):
    """The same documents, each read by many tasks."""
    return dates_as_text(registrations_in_splits(spark, sf_dir).curated)


@query(
    f"""
SELECT count(CASE WHEN vin_1_10 IS NULL THEN 1 END) AS vin_1_10_nulls,
       count(CASE WHEN dol_vehicle_id IS NULL THEN 1 END) AS dol_vehicle_id_nulls,
       count(CASE WHEN model_year IS NULL THEN 1 END) AS model_year_nulls,
       count(CASE WHEN make IS NULL THEN 1 END) AS make_nulls,
       count(CASE WHEN model IS NULL THEN 1 END) AS model_nulls,
       count(*) AS total_rows,
       count(DISTINCT coalesce(dol_vehicle_id, 'none')) AS distinct_dol_vehicle_id,
       count(*) <> count(DISTINCT coalesce(dol_vehicle_id, 'none')) AS has_duplicates,
       min(model_year) AS min_year, max(model_year) AS max_year,
       count(CASE WHEN n % 41 IN (0, 2) THEN 1 END) AS expected_date_failures
FROM {REGISTRATION_SQL}
"""
)
def curation_report(spark, sf_dir):
    """Every check of the run, in one row."""
    return registrations(spark, sf_dir).report()


@query(
    f"""
SELECT dol_vehicle_id, count(*) AS count FROM {REGISTRATION_SQL}
GROUP BY dol_vehicle_id HAVING count(*) > 1
"""
)
def curation_duplicates(spark, sf_dir):
    """The identifiers that occur more than once."""
    return registrations(spark, sf_dir).duplicates()


# The orders are dealt to as many documents as 99,998 records each make; a document's
# records stand by the line items' numbers and their own text.
REJECTS_SQL = """
SELECT reason, raw, position FROM (
SELECT n, reason, raw,
       row_number() OVER (PARTITION BY l_orderkey % documents ORDER BY n, raw) - 1 AS position FROM (
SELECT n, l_orderkey,
       (SELECT greatest(1, ceil(count(*) / 99998.0))::BIGINT FROM lineitem) AS documents,
       CASE WHEN n % 53 = 0 THEN 'too short' WHEN n % 59 = 0 THEN 'too long'
            WHEN n % 61 = 0 THEN 'null record' ELSE 'not an array' END AS reason,
       CASE WHEN n % 53 = 0 THEN '["row-' || n || '",' || vin || ',' || county || ']'
            WHEN n % 59 = 0 THEN '["row-' || n || '",' || vin || ',' || county || ',"' || l_linestatus || ']\\"",'
                 || CASE WHEN n % 5 = 0 THEN 'true' ELSE '"WA"' END || ',' || l_suppkey || ','
                 || CASE WHEN n % 11 = 0 THEN '"n/a"' WHEN n % 7 = 0 THEN '" ' || year || ' "'
                         WHEN n % 13 = 0 THEN '"' || left(year, 1) || '_' || right(year, 3) || '"'
                         ELSE year END
                 || ',"make-' || (l_partkey % 50) || '",'
                 || CASE WHEN n % 29 = 0 THEN 'null' WHEN n % 31 = 0 THEN quantity
                         ELSE '"model-' || l_partkey || '"' END
                 || ',["' || l_linenumber || '","x]"],'
                 || CASE n % 6 WHEN 0 THEN '"TRUE"' WHEN 1 THEN '"yes"' WHEN 2 THEN '0' WHEN 3 THEN 'true'
                               WHEN 4 THEN '" t"' ELSE 'null' END
                 || ',' || quantity || ',"'
                 || CASE WHEN n % 37 = 0 THEN '12d' ELSE CAST(l_extendedprice AS VARCHAR) END || '",'
                 || CASE WHEN n % 3 = 0 THEN 'true' ELSE CAST(n % 49 AS VARCHAR) END || ','
                 || CASE WHEN n % 19 <> 0 THEN '"D' || (l_orderkey * 10 + l_linenumber // 2) || '"'
                         ELSE 'null' END
                 || ',{"at":[' || l_partkey || ',' || l_suppkey || '],"type":"Point"},"utility",'
                 || CASE n % 41 WHEN 0 THEN '"junk"' WHEN 1 THEN 'null' WHEN 2 THEN '" ' || shipped || '"'
                                ELSE '"' || shipped || '"' END
                 || ',"unnamed","second","extra"]'
            WHEN n % 61 = 0 THEN 'null'
            ELSE '{"n":' || n || '}' END AS raw
FROM (SELECT *, l_orderkey * 10 + l_linenumber AS n,
             CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS quantity,
             CAST(2000 + (l_orderkey * 10 + l_linenumber) % 30 AS VARCHAR) AS year,
             CASE WHEN (l_orderkey * 10 + l_linenumber) % 17 <> 0
                  THEN '"  V' || (l_orderkey * 10 + l_linenumber) || ' "' ELSE 'null' END AS vin,
             '" ' || l_returnflag || '\\t "' AS county,
             strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS shipped
      FROM lineitem)))
WHERE n % 53 = 0 OR n % 59 = 0 OR n % 61 = 0 OR n % 67 = 0
"""


@query(REJECTS_SQL)
def curation_rejects(spark, sf_dir):
    """The records that were set aside, with their whole text and place."""
    return registrations(spark, sf_dir).rejects().select("reason", "raw", "position")


@query(REJECTS_SQL)
def curation_rejects_split(spark, sf_dir):
    """The same from documents read by many tasks."""
    rejects = registrations_in_splits(spark, sf_dir).rejects()
    return rejects.select("reason", "raw", "position")


@query(
    f"""
SELECT count(*) AS rows_written FROM {REGISTRATION_SQL}
WHERE vin_1_10 IS NOT NULL AND dol_vehicle_id IS NOT NULL
"""
)
def published_count(spark, sf_dir):
    """What ``publish`` reports: the rows that are left after the drop."""
    namespace = query_namespace(spark)
    rows = registrations(spark, sf_dir).publish("spark_catalog", namespace, "counted", fmt="parquet")
    return spark.createDataFrame([(rows,)], "rows_written bigint")


@query(
    f"""
SELECT * EXCLUDE (n) FROM {REGISTRATION_SQL}
WHERE vin_1_10 IS NOT NULL AND dol_vehicle_id IS NOT NULL
"""
)
def curation_published(spark, sf_dir):
    """The run's table, written to a catalog and read back."""
    namespace = query_namespace(spark)
    result = registrations(spark, sf_dir)
    result.publish("spark_catalog", namespace, "registrations", fmt="parquet")
    return dates_as_text(spark.table(f"spark_catalog.{namespace}.registrations"))
