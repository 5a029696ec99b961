"""A corpus from raw documents to packed sequences, stage by stage.

Each stage takes all that its predecessor kept, is written as Parquet and read again.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm import langid, line_templates, packing, simhash, substring
from recordloom.llm.folders import ship_package, table
from recordloom.llm.queries import BITS, END_ID, SHINGLE, WINDOW, vocabulary

#: Tokens of a sequence.
CAPACITY = 1024
#: Pieces of text whose ids a worker keeps: few, as workers go on to other stages.
KEPT_PIECES = 50_000


def counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they are now."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or between two languages, go."""
    ship_package(spark)
    return langid.keep(docs, langid.train(docs, F.lit(True)))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates stay in the first of their documents."""
    return counted(line_templates.drop_recurring(docs))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    ship_package(spark)
    return simhash.first_of_each(docs, SHINGLE, BITS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller id has are cut out."""
    ship_package(spark)
    return counted(substring.drop_repeats(docs, WINDOW))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their sequence and place."""
    ship_package(spark)
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"), END_ID, CAPACITY, kept=KEPT_PIECES)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: SQL has no form for language identification, fingerprints and packing; tests/llm
#: compare every stage with a plain version of its own.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = table(stage(spark, docs, sf_dir), name)
    return docs
