"""Best-fit packing of documents into sequences, planned on the counts of lengths.

How many pieces there are of each length is all that best-fit decreasing needs, so the
plan is made from a histogram of at most ``capacity`` numbers, however many documents
there are. It is a list of runs: so many pieces of a length, from a rank on, go one each
into consecutive sequences at one offset. Pieces are then numbered within their length
and take the slot of their number by a join.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm.encoder import SLICE_BYTES, Encoder
from recordloom.llm.folders import table
from recordloom.llm.text import buffers, slices

PLAN = "length long, rank_from long, pieces long, sequence_from long, offset long"


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: the runs as (length, rank, pieces, sequence, offset).

    Pieces of length 0 share the first sequence. A step ends a length or moves a whole
    run of sequences on to a smaller rest, so the runs are few (about 15,000 for a
    capacity of 1024) whatever the counts.
    """
    runs: list[tuple[int, int, int, int, int]] = []
    rests: dict[int, list[tuple[int, int]]] = {}  # free tokens -> runs of sequences
    sequences = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        rank = 0
        if length < 1:
            runs.append((length, 0, left, 0, 0))
            sequences = max(sequences, 1)
            continue
        if length > capacity:
            raise ValueError(f"a piece of {length} does not fit into {capacity}")
        while left and any(r >= length and rests[r] for r in rests):
            rest = min(r for r in rests if r >= length and rests[r])
            first, count = rests[rest].pop()
            used = min(count, left)
            runs.append((length, rank, used, first, capacity - rest))
            rank, left = rank + used, left - used
            if count > used:
                rests[rest].append((first + used, count - used))
            if rest > length:
                rests.setdefault(rest - length, []).append((first, used))
        each = capacity // length
        for per, count in ((each, left // each), (left % each, 1)):
            if per and count:
                for k in range(per):
                    runs.append((length, rank, count, sequences, k * length))
                    rank += count
                if capacity > per * length:
                    rests.setdefault(capacity - per * length, []).append((sequences, count))
                sequences += count
    return runs


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (any columns, with ``length``) plus ``sequence_id`` and ``offset``.

    Null lengths count as 0. The columns added replace any of the same name. The
    pieces are written to the shared folder first, numbered within length and task, so
    that a task computed again cannot number them otherwise.
    """
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset", "length")]
    length = F.coalesce(F.col("length").cast("long"), F.lit(0)).alias("length")
    plain = pieces.select(F.struct(*kept).alias("piece"), length)
    numbered = table(plain.mapInArrow(_numbered, _with_rank(plain)), "pieces")
    counts = numbered.groupBy("length", "task").agg((F.max("rank") + 1).alias("pieces"))
    counts = table(counts, "lengths")
    histogram = {row.length: row.pieces for row in counts.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect()}
    runs = pieces.sparkSession.createDataFrame(plan(histogram, capacity), PLAN)
    before = F.sum("pieces").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    bases = counts.select("length", "task", F.coalesce(before, F.lit(0)).alias("base"))
    ranked = numbered.join(bases, ["length", "task"]).select("piece", "length", (F.col("rank") + F.col("base")).alias("rank"))
    runs = runs.withColumnRenamed("length", "of_length")
    at = F.col("rank") - F.col("rank_from")
    placed = ranked.join(
        F.broadcast(runs),  # about 15 rows for each token of the capacity, however many documents
        (F.col("length") == F.col("of_length")) & (at >= 0) & (at < F.col("pieces")),
    )
    columns = [F.col("piece")[c].alias(c) if c != "length" else F.col("length") for c in pieces.columns if c in kept or c == "length"]
    return placed.select(*columns, (F.col("sequence_from") + at).alias("sequence_id"), F.col("offset"))


def _with_rank(plain: DataFrame):
    from pyspark.sql.types import LongType, StructField, StructType

    more = [StructField("task", LongType()), StructField("rank", LongType())]
    return StructType([*plain.schema.fields, *more])


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's number, and each row's place among the task's rows of its length."""
    task, seen = TaskContext.get().partitionId(), np.zeros(1, np.int64)
    for batch in batches:
        lengths = batch.column("length").to_numpy(zero_copy_only=False)
        order = np.argsort(lengths, kind="stable")
        in_order = lengths[order]
        new = np.flatnonzero(np.concatenate([[True], in_order[1:] != in_order[:-1]]))
        within = np.arange(len(order)) - np.repeat(new, np.diff([*new, len(order)]))
        if len(in_order) and in_order[-1] >= len(seen):
            seen = np.append(seen, np.zeros(in_order[-1] + 1 - len(seen), np.int64))
        ranks = np.empty(len(order), np.int64)
        ranks[order] = within + seen[in_order]
        seen += np.bincount(lengths, minlength=len(seen))
        columns = [*batch.columns, pa.array(np.full(len(order), task)), pa.array(ranks)]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "task", "rank"])


def cut_lengths(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter than ``capacity``."""
    if length <= capacity:
        return [(0, length)]
    first = length % capacity
    starts = [0] * (first > 0) + list(range(first, length, capacity))
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], length])]


def document_pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int, with_ids: bool = False, kept: int | None = None
) -> DataFrame:
    """The pieces of every document: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``.

    ``tokenizer`` is the text of a tokenizer's JSON file, ``kept`` the pieces of text whose
    ids a worker keeps (fewer take less memory and more time). Null texts are empty and
    so are one piece that holds the end id alone.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer, kept)
        for batch in slices(batches, "text", SLICE_BYTES):
            rows = []
            for row, ids in enumerate(encoder.encode_utf8(*buffers(batch.column("text")))):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for piece, (start, length) in enumerate(cut_lengths(len(ids), capacity)):
                    own = ids[start : start + length]
                    rows.append((row, piece, start, length, zlib.crc32(own), own if with_ids else None))
            of = batch.column("doc_id").take(pa.array([r[0] for r in rows], pa.int32()))
            columns = [of, *(pa.array([r[k] for r in rows], pa.int64()) for k in (1, 2, 3, 4))]
            if with_ids:
                columns.append(pa.array([r[5] for r in rows], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    schema = "doc_id long, piece long, start long, length long, ids_crc32 long"
    return plain.mapInArrow(cut, schema + ", ids array<long>" * with_ids)


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int, with_ids: bool = False, kept: int | None = None
) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    return pack(document_pieces(docs, tokenizer, end_id, capacity, with_ids, kept), capacity)
