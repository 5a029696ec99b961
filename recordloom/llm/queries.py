"""The registered queries of these operators, with their SQL where it can express them.

``QUERIES`` and ``ORACLES`` are what the entry module adds. Each query applies one
operator to its whole table and derives the columns that are compared.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm import (
    bpe,
    conversations,
    hard_negatives,
    knn,
    langid,
    line_templates,
    ngram_lm,
    packing,
    pieces,
    repetition,
    simhash,
    substring,
    token_store,
)
from recordloom.llm.folders import ship_package
from recordloom.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

#: The token that ends a document.
END_ID = 2

#: Words of the language model's longest n-gram.
ORDER = 3

#: Substring dedup: words of a window.
WINDOW = 13

#: SimHash near-dedup: words in a shingle, largest number of differing bits.
SHINGLE, BITS = 4, 4


def query(function):
    QUERIES[function.__name__] = function
    return function


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def vocabulary(name: str) -> str:
    """The text of a public vocabulary file; tasks get it with their code."""
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_text(encoding="utf-8")


def remainder_is_2(modulus: int) -> Column:
    """The documents that are held out; one without an id is not."""
    rest = F.crc32(F.col("doc_id").cast("string")) % modulus
    return F.coalesce(rest == 2, F.lit(False))


@query
def op1_ngram_lm(spark, sf_dir):
    """Scores of all texts by a model counted on those that are not held out."""
    docs = documents(spark, sf_dir)
    model = ngram_lm.train(docs.where(~remainder_is_2(7)), order=ORDER)
    scored = ngram_lm.score(docs, model)
    return scored.select("doc_id", remainder_is_2(7).alias("held_out"), *scored.columns[1:])


@query
def op2_simhash(spark, sf_dir):
    """Components of fingerprints of 4-word shingles at 4 or fewer differing bits."""
    found = simhash.near_duplicates(documents(spark, sf_dir), SHINGLE, BITS)
    hexadecimal = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", hexadecimal.alias("fingerprint"), "component_id")


@query
def op3_exact_top_k(spark, sf_dir):
    """The 20 highest inner products of every twentieth vector with all others."""
    ship_package(spark)
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    vectors = vectors.select("vec_id", knn.quantized(F.col("embedding"), 64).alias("vector"))
    return knn.top_k(vectors, vectors.where("vec_id % 20 = 0"), 20)


@query
def op4_substring_dedup(spark, sf_dir):
    """What is left of every text when 13-word windows of smaller documents are removed."""
    return substring.digests(documents(spark, sf_dir), WINDOW)


@query
def op5_best_fit_packing(spark, sf_dir):
    """Every document's pieces of at most 1024 tokens, packed into sequences."""
    docs = documents(spark, sf_dir)
    packed = packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"), END_ID, 1024)
    return packed.withColumn("piece", F.col("piece").cast("int"))


@query
def op6_repetition(spark, sf_dir):
    """Repetition counts and shares, the base rule and the verdict of every text."""
    return repetition.score(documents(spark, sf_dir))


@query
def op7_line_templates(spark, sf_dir):
    """Every text without the lines of templates that recur across documents."""
    found = line_templates.drop_recurring(documents(spark, sf_dir), counts=True)
    return found.select("doc_id", "n_lines", "n_dropped", "text")


@query
def op8_token_store(spark, sf_dir):
    """Ids written to compressed files and read back."""
    folder = token_store.write_store(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), END_ID)

    def crc32(many):
        return pa.array([zlib.crc32(ids.tobytes()) for ids in many], pa.int64())

    return token_store.store_rows(spark, folder, crc32, "ids_crc32 long")


@query
def op9_byte_bpe(spark, sf_dir):
    """Ids by the ranks of the vocabulary, and the bytes they decode to."""
    import public_tokenizers

    docs = documents(spark, sf_dir)
    return bpe.digests(docs, vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op10_language_id(spark, sf_dir):
    """The language of every text, learned from the labelled rows that are not held out."""
    docs = documents(spark, sf_dir)
    model = langid.train(docs, ~remainder_is_2(4))
    found = langid.identify(docs, model)
    return found.select("doc_id", remainder_is_2(4).alias("held_out"), *found.columns[1:])


def damaged(turns: DataFrame) -> DataFrame:
    """Every twentieth row or so dropped, emptied, without its marks, repeated, or the user's."""
    space = F.lit(" ")
    named = (F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn"))
    fate = F.crc32(F.concat_ws(":", *named)) % 20
    role, text = (F.coalesce(F.col(c), space) for c in ("role", "text"))
    return turns.select(
        "conv_id",
        "turn",
        F.when(fate == 4, "user").otherwise(role).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("copies"),
    )


@query
def op11_conversations(spark, sf_dir):
    """Faults, cheapest edits and repaired text of every damaged conversation."""
    ship_package(spark)
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversations.repair(damaged(turns)).report


@query
def op13_hard_negatives(spark, sf_dir):
    """The hardest rows of other labels for every fiftieth vector and each of its 5 positives."""
    ship_package(spark)
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.col("label").cast("long")
    noisy = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    vectors = vectors.select("vec_id", noisy.alias("label"), knn.quantized(F.col("embedding"), 256).alias("vector"))
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0)


@query
def op12_pieces(spark, sf_dir):
    """Ids of a byte-pair model with spaces as symbols, and the text they decode to."""
    import public_tokenizers

    model = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    return pieces.digests(documents(spark, sf_dir), model)
