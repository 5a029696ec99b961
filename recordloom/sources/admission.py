"""Which documents of a batch can be loaded, and what is wrong with the others.

``Export.open`` fails for the whole batch at the first fault. Here every document has a row,
so that the good ones can be loaded without the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.sources.envelope import ENVELOPE, WHOLE_DOCUMENT_BYTES, Paths, is_large, listed_files
from recordloom.sources.reading import reading_session
from recordloom.sources.split_scan import MARKED, NOT_TEXT, STRICT, TWICE, Structure, keys_named_data

# Faults of a document.
EMPTY, MALFORMED, NO_DATA, NO_LIST, NO_RECORDS, NO_COLUMNS = (
    "a document is empty",
    "a file is not one JSON document",
    "a document has no data",
    "data is not a list",
    "a document has no records",
    "a document has no column metadata",
)


def admission(
    spark: SparkSession, paths: Paths, whole_document_bytes: int = WHOLE_DOCUMENT_BYTES
) -> DataFrame:
    """``source, described, records, fault`` of every file, empty ones among them.

    ``described`` stands for the document's column metadata: documents with the same one can
    be loaded together. ``fault`` is NULL for a document that can be loaded. One pass over the text;
    of a document above ``whole_document_bytes`` the elements of its lists are counted, and parsed only when
    they are loaded.
    """
    own = reading_session(spark)
    files = listed_files(own, paths)
    large = is_large(F.col("_metadata.file_path"), F.col("_metadata.file_size"), whole_document_bytes)
    rows = _whole(own, paths, ~large)
    if not files.where(is_large(F.col("source"), F.col("size"), whole_document_bytes)).isEmpty():
        rows = rows.unionByName(_split(own, paths, large))
    empty = files.where("size = 0").select(
        "source", F.lit(None).cast("bigint").alias("described"), F.lit(0).cast("bigint").alias("records"), F.lit(EMPTY).alias("fault")
    )
    return rows.unionByName(empty)


def _judged(documents: DataFrame, records: Column | None) -> DataFrame:
    """``source``, ``text`` and a fault known ``before`` to the documents' rows.

    The text is parsed as by the readers, as the first of two elements of a list, without failing.
    """
    fields = ", ".join(f"{name}:{kind}" for name, kind in (field.split(" ", 1) for field in ENVELOPE.split(", ")))
    text, sound = F.col("text"), F.col("before").isNull()
    listed = F.concat(F.lit("["), text, F.lit(",null]"))
    parsed = F.when(sound, F.from_json(listed, f"array<struct<{fields}>>", STRICT | {"mode": "PERMISSIVE"}))
    opened = documents.withColumn("parsed", parsed)
    doc, keys = F.get("parsed", F.lit(0)), F.when(sound, F.json_object_keys(text))
    data = F.when(sound & doc["data"].isNull(), F.get_json_object(text, "$.data"))
    columns = doc["meta"]["view"]["columns"]
    described = F.when(F.size(columns) > 0, F.xxhash64(F.to_json(columns)))
    # any JSON, where it is not what the readers expect
    other = F.from_json(listed, "array<struct<data:variant>>", STRICT | {"mode": "PERMISSIVE"})
    expected = F.coalesce(F.size("parsed") == 2, F.lit(False))
    n = F.size(doc["data"]) if records is None else records
    fault = (
        F.when(~sound, F.col("before"))
        .when(keys.isNull() | ~(expected | F.coalesce(F.size(other) == 2, F.lit(False))), MALFORMED)
        .when(keys_named_data(keys) > 1, TWICE)
        .when(data.isNotNull(), NO_LIST)
        .when(doc["data"].isNull(), NO_DATA)
        .when(n == 0, NO_RECORDS)
        .when(described.isNull(), NO_COLUMNS)
    )
    found = F.when(expected & doc["data"].isNotNull(), n).otherwise(0).cast("bigint")
    return opened.select("source", described.alias("described"), found.alias("records"), fault.alias("fault"))


def _whole(spark: SparkSession, paths: Paths, files: Column) -> DataFrame:
    """Documents that are read whole: each is parsed by its task."""
    text = spark.read.text(paths, wholetext=True).where(files)
    value = F.col("value")
    fault = (
        F.when(~F.is_valid_utf8(value) | F.contains(value, F.lit("\0")), NOT_TEXT)
        .when(F.startswith(value, F.lit("\ufeff")), MARKED)
    )
    documents = text.select(F.col("_metadata.file_path").alias("source"), value.alias("text"), fault.alias("before"))
    return _judged(documents, None)


def _split(spark: SparkSession, paths: Paths, files: Column) -> DataFrame:
    """Documents that are read in splits: their structure, and their text without lists."""
    structure = Structure.scan(spark, paths, files)
    faults = structure.faults.select("document", F.col("fault").alias("before"))
    documents = structure.sources.select("document", "source").join(faults, "document")
    texts = structure.skeletons().select("document", "text", F.col("records").alias("found"))
    return _judged(documents.join(texts, "document", "left"), F.col("found"))
