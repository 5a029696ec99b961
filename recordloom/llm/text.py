"""Whole texts as numpy arrays: words, their hashes and n-grams, for many documents at once."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Bytes of text worked on at once; a longer document is a slice of its own.
SLICE_BYTES = 2 << 20

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_BYTE_CODES = np.random.default_rng(20).integers(0, 1 << 64, 256, dtype=np.uint64)
#: Bytes hashed at a time, and spans compared.
_BLOCK = 1 << 16


@cache
def _allocator() -> ctypes.CDLL | None:
    """The C library of a worker, set to use the memory of arrays up to 32 MB again, not to map it anew each time."""
    try:
        libc = ctypes.CDLL("libc.so.6")
        libc.mallopt(-3, 32 << 20)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, 64 << 20)  # M_TRIM_THRESHOLD
    except (OSError, AttributeError):
        return None
    return libc


def return_freed_memory() -> None:
    """Give back to the system what a task has freed: workers live on, and hold it otherwise."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError):
        _allocator().malloc_trim(0)


def utf8(column: str | Column) -> Column:
    """The text's bytes, empty for null; workers need not decode them."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("binary")


def slices(
    batches: Iterator[pa.RecordBatch],
    column: str | Callable[[pa.RecordBatch], pa.Array],
    limit: int = SLICE_BYTES,
) -> Iterator[pa.RecordBatch]:
    """The rows in slices of at most ``limit`` bytes of a text column, one row at least."""
    _allocator()
    of = column if callable(column) else lambda batch: batch.column(column)
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(of(batch)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            used = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, used + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to
    return_freed_memory()


def rows_that(docs: DataFrame, judge: Callable[[pa.Array], np.ndarray], limit: int = SLICE_BYTES) -> DataFrame:
    """The rows of ``docs``, with all columns, whose text (as UTF-8) the judge accepts; no shuffle."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))

    def text(batch: pa.RecordBatch) -> pa.Array:
        return batch.column("row").field("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, limit):
            accepted = pa.array(judge(pc.fill_null(text(batch).cast(pa.binary()), b"")))
            yield pa.RecordBatch.from_arrays([batch.column("row").filter(accepted)], ["row"])

    schema = StructType([StructField("row", docs.schema)])
    return docs.select(row.alias("row")).mapInArrow(run, schema).select("row.*")


def buffers(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text or binary column; nulls are empty."""
    array = pc.fill_null(array.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def lower(data: np.ndarray) -> np.ndarray:
    """A to Z in lower case, all else as it is."""
    out = data.copy()
    out[(data >= 65) & (data <= 90)] += 32
    return out


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a slice of documents, in order.

    ``start`` and ``end`` are byte positions, ``doc`` is the document's place in the
    slice, ``first`` the place of each document's first word (one entry more than
    documents).
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        _allocator()
        self.data, self.offsets = data, offsets
        space = (data == 32) | ((data >= 9) & (data <= 13))
        cut = np.ones(len(data) + 1, bool)
        cut[1:] = space
        cut[offsets] = True
        self.start = np.flatnonzero(~space & cut[:-1])
        cut[:-1] = space
        cut[-1] = True
        cut[offsets] = True
        self.end = np.flatnonzero(~space & cut[1:]) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        """Words of each document."""
        return np.diff(self.first)


@cache
def _powers(base: int, count: int) -> np.ndarray:
    """``base`` to the powers 0 to ``count``, less one, modulo 2^64."""
    steps = np.full(count, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit value spread over all of them (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, the same for equal bytes wherever they are.

    A polynomial rolling hash over random codes of the bytes, from running sums.
    """
    sums = np.zeros(len(data) + 1, np.uint64)
    powers = _powers(_MULTIPLIER, _BLOCK)
    for at in range(0, len(data), _BLOCK):
        codes = _BYTE_CODES[data[at : at + _BLOCK]]
        codes *= powers[: len(codes)]
        codes *= np.uint64(pow(_MULTIPLIER, at, 1 << 64))
        codes[:1] += sums[at : at + 1]
        np.cumsum(codes, out=sums[at + 1 : at + 1 + len(codes)])
    of_blocks = np.array([pow(_INVERSE, at, 1 << 64) for at in range(0, len(data) + 1, _BLOCK)], np.uint64)
    hashed = sums[end] - sums[start]
    hashed *= _powers(_INVERSE, _BLOCK)[start & (_BLOCK - 1)]
    hashed *= of_blocks[start // _BLOCK]
    return mix(hashed ^ mix((end - start).astype(np.uint64)))


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Rolling hashes of ``n`` consecutive values, one per start (documents not heeded)."""
    count = max(0, len(hashes) - n + 1)
    out = np.zeros(count, np.uint64)
    for k in range(n):
        out *= np.uint64(_MULTIPLIER)
        out += hashes[k : k + count]
    return mix(out)


def whole(words: Words, n: int) -> np.ndarray:
    """Which n-gram starts lie with all ``n`` words in one document."""
    count = max(0, len(words) - n + 1)
    return words.doc[:count] == words.doc[n - 1 :][:count]


def alike(data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """One span of each kind of equal bytes, and for every span the number of its kind.

    Spans are told apart by their hashes (``span_hashes``) and then compared byte by byte;
    where two of one hash differ, every span is a kind of its own.
    """
    hashes, every = span_hashes(data, start, end) if hashes is None else hashes, np.arange(len(start))
    of, open_ = np.empty(len(start), np.int64), every
    table, shift = np.empty(1 << 20, np.int64), 0
    while len(open_):
        slot = (hashes[open_] >> np.uint64(shift)).astype(np.int64) & (len(table) - 1)
        table[slot] = open_  # of those that meet in a slot, one stays
        found = table[slot]
        same = hashes[found] == hashes[open_]
        of[open_[same]] = found[same]
        open_ = open_[~same]
        shift = (shift + 7) % 44
    size = end - start
    if not (size[of] == size).all() or not _same_bytes(data, start[of], start, size):
        return every, every
    first = np.flatnonzero(of == every)
    number = np.empty(len(start), np.int64)
    number[first] = np.arange(len(first))
    return first, number[of]


def _same_bytes(data: np.ndarray, one: np.ndarray, other: np.ndarray, size: np.ndarray) -> bool:
    """Are the spans from ``one`` equal to those from ``other``?"""
    differ = np.flatnonzero(one != other)
    return not any(map(len, unequal(data, one[differ], data, other[differ], size[differ])))


def unequal(data: np.ndarray, one: np.ndarray, others: np.ndarray, other: np.ndarray, size: np.ndarray) -> Iterator[np.ndarray]:
    """The spans from ``one`` of ``data`` that differ from those from ``other`` of ``others``, by blocks of some bytes, one span at least."""
    ends = np.cumsum(size)
    at = 0
    while at < len(size):
        used = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, used + 4 * _BLOCK, side="right")))
        many = size[at:to]
        within = np.arange(many.sum()) - np.repeat(ends[at:to] - many - used, many)
        differ = np.flatnonzero(data[within + np.repeat(one[at:to], many)] != others[within + np.repeat(other[at:to], many)])
        yield np.unique(at + np.searchsorted(ends[at:to] - used, differ, side="right"))
        at = to
