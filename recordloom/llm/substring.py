"""Substring dedup by prefix-partitioned suffix trees.

A suffix begins at every word that starts a window of ``window`` words in a document. Two
windows are equal where their suffixes meet in the suffix tree at that depth or below,
so the nodes at this depth with leaves of several documents are the repeats.

1. Documents are packed into slices of a few MB, written as a bucketed table: a slice is
   read by one task at a time, and later joins by slice do not move text.
2. A suffix whose first ``window`` words occur nowhere else hangs alone below that
   depth. A filter finds these by short hashes of the windows, which are all that is
   shuffled here (sorted, as differences), and answers each slice with a bit for each.
   Equal windows have equal hashes, so no repeat is lost; the rest is settled by the trees.
3. The remaining suffixes go, with their words, to the group of their prefix. A prefix is
   one word where few suffixes share it and longer where many do: prefixes that a group
   could not hold are known from counts of frequent prefixes, and are extended word by
   word. A slice leaves a prefix out of its counts below its own part, by windows, of
   what all may leave out, so none of more than ``(FREQUENT + 1 / 2) * GROUP`` suffixes is
   missed, however many slices share it. Copies within a slice are sent once.
4. Each group builds its trees level by level, splitting the nodes by the next word and
   ending those with one leaf, and compares the words themselves. It answers each slice
   with one bit for each suffix: does a document with a smaller id have it? Within a slice, windows
   of one hash are told apart by their words before, so that nowhere a hash alone decides.

Defined results: null texts have no words; a null ``doc_id`` counts as larger than all
others; rows that repeat an id are one document (a window is never removed because of a
row with the same id). Columns other than id and text pass through.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.folders import table
from recordloom.llm.text import Words, alike, buffers, mix, ngrams, return_freed_memory, slices, span_hashes, utf8, whole
from recordloom.sources.scratch import scratch_path

#: Suffixes of a group of prefixes, and hashes of a part of the filter.
GROUP, FILTER_PART = 700_000, 2_000_000
#: Bytes of text in a slice.
SLICE_BYTES = 4 << 20
#: Bits of a window's hash that the filter compares, besides those that choose its part.
FILTER_BITS = 32
#: Share of a group's suffixes that all slices together may leave out of a prefix's count.
FREQUENT = 0.25
LAST = np.int64(2**63 - 1)

@cache
def _compressor() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=3)


@cache
def _decompressor() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def _press(raw: bytes) -> bytes:
    return _compressor().compress(raw)


def _unpress(raw: bytes) -> bytes:
    return _decompressor().decompress(raw) if raw else b""


# Slices

SLICE = pa.schema([("slice", pa.int64()), ("windows", pa.int64()), ("rows", pa.binary())])


def _pack_rows(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as stream:
        stream.write_batch(batch)
    return _press(sink.getvalue())


def _rows(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(_unpress(payload)).read_all().combine_chunks()


class Slice:
    """The words of a slice's documents and its windows."""

    def __init__(self, payload: bytes, window: int):
        self.table = _rows(payload)
        texts = self.table["text"].combine_chunks() if self.table.num_rows else pa.array([], pa.binary())
        self.words = Words(*buffers(texts))
        self.window = window
        self.hashes = span_hashes(self.words.data, self.words.start, self.words.end)
        self.starts = np.flatnonzero(whole(self.words, window))
        self.ids = self.table["doc_id"].fill_null(int(LAST)).to_numpy()
        #: The windows' hashes, the places of each distinct one, and its least document.
        self.keys, self.of = np.unique(ngrams(self.hashes, window)[self.starts], return_inverse=True)
        self._compare_words()
        owner = self.ids[self.words.doc[self.starts]]
        self.least = np.full(len(self.keys), LAST)
        np.minimum.at(self.least, self.of, owner)
        most = np.full(len(self.keys), np.int64(-(2**63)))
        np.maximum.at(most, self.of, owner)
        self.several = most > self.least
        self.owner = owner


    def _compare_words(self) -> None:
        """Windows of one hash but with other words become distinct windows of that hash."""
        times = np.bincount(self.of, minlength=len(self.keys))
        again = np.flatnonzero(times[self.of] > 1)
        if not len(again):
            return
        at, words = self.starts[again], self.words
        steps = np.zeros(len(words) + 1, np.int64)
        np.add.at(steps, at, 1)
        np.add.at(steps, at + self.window, -1)
        covered = np.flatnonzero(np.cumsum(steps)[:-1] > 0)
        number = np.zeros(len(words), np.int64)
        number[covered] = alike(words.data, words.start[covered], words.end[covered])[1]
        first = np.zeros(len(self.keys), np.int64)
        first[self.of[again[::-1]]] = at[::-1]
        other = np.zeros(len(again), bool)
        for k in range(self.window):
            other |= number[at + k] != number[first[self.of[again]] + k]
        if other.any():
            kind = np.zeros(len(self.starts), np.int64)
            rows = number[at[other][:, None] + np.arange(self.window)]
            kind[again[other]] = np.unique(rows, axis=0, return_inverse=True)[1].ravel() + 1
            kinds = int(kind.max()) + 1
            found, self.of = np.unique(self.of * kinds + kind, return_inverse=True)
            self.keys = self.keys[found // kinds]


def _parts(keys: np.ndarray, parts: int) -> np.ndarray:
    """Ends of the filter's parts in sorted hashes."""
    cuts = [min((1 << 64) - 1, -(-(k << 64) // parts)) for k in range(1, parts)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(cuts, np.uint64)), [len(keys)]])


def _codes(keys: np.ndarray, parts: int) -> np.ndarray:
    """What the filter compares of a hash: the bits after those that tell its part, so in the same order."""
    return (keys * np.uint64(parts)) >> np.uint64(64 - FILTER_BITS)


def _sliced(docs: DataFrame, window: int, id_column: str) -> tuple[DataFrame, int, int]:
    """The bucketed table of slices, the number of windows, and of buckets."""
    spark = docs.sparkSession
    rest = [c for c in docs.columns if c not in (id_column, "text")]
    plain = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        utf8("text").alias("text"),
        F.col("text").isNull().alias("null_text"),
        F.struct(*(F.col(f"`{c}`") for c in rest)).alias("rest") if rest else F.lit(None).cast("int").alias("rest"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in slices(batches, "text", SLICE_BYTES):
            words = Words(*buffers(batch.column("text"))).counts()
            windows = int(np.maximum(words - window + 1, 0).sum())
            yield pa.RecordBatch.from_arrays([[number], [windows], [_pack_rows(batch)]], schema=SLICE)
            number += 1

    packed = plain.mapInArrow(run, "slice long, windows long, rows binary")
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(1, -(-size // (16 << 20)))
    path = scratch_path(spark, "slices")
    name = "slices_" + path.rsplit("-", 1)[-1]
    writer = packed.write.format("parquet").option("path", path).option("compression", "none")
    writer.bucketBy(buckets, "slice").saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # its entry alone: the files are not the catalog's
    return stored, stored.agg(F.coalesce(F.sum("windows"), F.lit(0))).first()[0], buckets


# The filter

PIECE = pa.schema([("part", pa.int32()), ("slice", pa.int64()), ("payload", pa.binary()), ("kind", pa.int32())])
PIECE_SQL = "part int, slice long, payload binary, kind int"
CODES, PREFIXES = 0, 1


def _piece(part: int, number: int, payload: bytes, kind: int = CODES) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([[part], [number], [payload], [kind]], schema=PIECE)


def _frequent(found: Slice, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(prefix hash, suffixes) of the prefixes that many suffixes of the slice have."""
    at, level, prefixes, counts = found.starts, 1, [], []
    while len(at) and level <= found.window:
        keys = _prefix(found.hashes, at, level)
        slot = (keys >> np.uint64(44)).astype(np.int64)
        some = np.bincount(slot, minlength=1 << 20)[slot] >= least  # rarer ones need not be sorted
        at, keys = at[some], keys[some]
        values, of, times = np.unique(keys, return_inverse=True, return_counts=True)
        often = times >= least
        prefixes.append(values[often])
        counts.append(times[often])
        at, level = at[often[of]], level + 1
    return np.concatenate([*prefixes, np.zeros(0, np.uint64)]), np.concatenate([*counts, np.zeros(0, np.int64)])


def _prefix(hashes: np.ndarray, at: np.ndarray, level: int) -> np.ndarray:
    """Hashes of the first ``level`` words of suffixes."""
    key = np.full(len(at), np.uint64(level))
    for k in range(level):
        key = mix(key + hashes[at + k])
    return key


def _filter(stored: DataFrame, window: int, windows: int) -> tuple[DataFrame, DataFrame]:
    """(slice, bits of its distinct windows that may repeat), and frequent prefixes."""
    parts = max(1, -(-windows // FILTER_PART))
    left_out = FREQUENT * GROUP / max(1, windows)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, payload in zip(batch.column("slice").to_pylist(), batch.column("rows")):
                found = Slice(payload.as_py(), window)
                ends = _parts(found.keys, parts)
                for part in np.flatnonzero(np.diff(ends)):
                    own = slice(ends[part], ends[part + 1])
                    codes = _codes(found.keys[own], parts)
                    steps = np.diff(codes, prepend=np.uint64(0)).astype(np.uint32)
                    flags = np.packbits(found.several[own]).tobytes()
                    # the bytes of the differences apart: the high ones are nearly all zero
                    planes = steps.view(np.uint8).reshape(-1, 4).T.tobytes()
                    yield _piece(int(part), number, _press(len(codes).to_bytes(8, "little") + flags + planes))
                prefixes, times = _frequent(found, left_out * len(found.starts))
                if len(prefixes):
                    both = prefixes.tobytes() + times.astype(np.int64).tobytes()
                    yield _piece(-1, number, both, PREFIXES)
                del found
                return_freed_memory()  # the next slice takes as much

    pieces = table(stored.select("slice", "rows").mapInArrow(coded, PIECE_SQL), "filter")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All pieces of a part: which of their codes are in several, or in several documents."""
        held, part = [], None
        for batch in batches:
            for row in range(batch.num_rows):
                part = batch.column("part")[row].as_py()
                raw = _unpress(batch.column("payload")[row].as_py())
                count = int.from_bytes(raw[:8], "little")
                flag_bytes = (count + 7) // 8
                flags = np.unpackbits(np.frombuffer(raw, np.uint8, flag_bytes, 8), count=count).astype(bool)
                planes = np.frombuffer(raw, np.uint8, 4 * count, 8 + flag_bytes).reshape(4, count)
                codes = np.cumsum(planes.T.copy().view(np.uint32).ravel(), dtype=np.uint64).astype(np.uint32)
                held.append((batch.column("slice")[row].as_py(), codes, flags))
        if not held:
            return
        codes = np.sort(np.concatenate([h[1] for h in held]))
        twice = np.unique(codes[1:][codes[1:] == codes[:-1]])
        del codes
        for number, codes, flags in held:
            there = flags.copy()
            if len(twice):
                at = np.minimum(np.searchsorted(twice, codes), len(twice) - 1)
                there |= twice[at] == codes
            yield _piece(part, number, np.packbits(there).tobytes())

    codes = pieces.where(F.col("kind") == CODES).repartitionById(parts, F.col("part"))
    bits = codes.mapInArrow(compared, PIECE_SQL)
    bits = bits.groupBy("slice").agg(F.collect_list(F.struct("part", "payload")).alias("bits"))
    return bits, pieces.where(F.col("kind") == PREFIXES).select("payload")


def _split_prefixes(reported: DataFrame) -> np.ndarray:
    """Prefixes with more suffixes than a group holds: at most windows / GROUP for each length."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column("payload"):
                prefixes, times = np.frombuffer(payload.as_py(), np.int64).reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(prefixes), pa.array(times)], ["prefix", "times"])

    counts = reported.mapInArrow(opened, "prefix long, times long").groupBy("prefix").agg(F.sum("times").alias("times"))
    large = counts.where(F.col("times") > GROUP // 2).select("prefix").collect()
    return np.sort(np.array([row.prefix for row in large], np.int64).view(np.uint64))


def _member(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[at] == values


def _group_of(hashes: np.ndarray, at: np.ndarray, window: int, split: np.ndarray) -> np.ndarray:
    """The hash of each suffix's prefix: the shortest that is not to be split."""
    key = _prefix(hashes, at, 1)
    longer, level = np.flatnonzero(_member(split, key)), 1
    while len(longer) and level < window:
        level += 1
        key[longer] = _prefix(hashes, at[longer], level)
        longer = longer[_member(split, key[longer])]
    return key


# Suffix trees

TREE_SQL = "part int, slice long, payload binary, kind int"


def _survivors(found: Slice, bits: list, parts: int) -> np.ndarray:
    """Places, among the slice's distinct windows, of those that the filter left."""
    ends, left = _parts(found.keys, parts), np.zeros(len(found.keys), bool)
    for entry in bits:
        own = slice(ends[entry["part"]], ends[entry["part"] + 1])
        left[own] = np.unpackbits(np.frombuffer(entry["payload"], np.uint8), count=own.stop - own.start).astype(bool)
    return np.flatnonzero(left)


def _suffixes(found: Slice, bits: list, parts: int, split: np.ndarray, groups: int):
    """(group, places among distinct windows in the order sent) of the suffixes left."""
    left = _survivors(found, bits, parts)
    first = np.zeros(len(found.keys), np.int64)
    first[found.of[::-1]] = found.starts[::-1]
    prefix = _group_of(found.hashes, first[left], found.window, split)
    group = (mix(prefix) >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)
    order = np.lexsort((prefix, group))
    left, group = left[order], group[order].astype(np.int64)
    ends = np.searchsorted(group, np.arange(groups + 1))
    for k in np.flatnonzero(np.diff(ends)):
        own = left[ends[k] : ends[k + 1]]
        yield int(k), own, first[own]


def _stretches(found: Slice, at: np.ndarray) -> bytes:
    """The words of the suffixes' windows, one after the other, with single spaces and line ends."""
    return b"".join(_stretch(found, at[k : k + 4096]) for k in range(0, len(at), 4096))


def _stretch(found: Slice, at: np.ndarray) -> bytes:
    """The same of a few."""
    words, last = found.words, at + found.window - 1
    start, size = words.start[at], words.end[last] - words.start[at]
    ends = np.cumsum(size + 1)
    out = np.full(int(ends[-1]), 10, np.uint8)
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    raw = words.data[np.repeat(start, size) + place]
    raw[(raw == 32) | ((raw >= 9) & (raw <= 13))] = 32
    out[np.repeat(ends - size - 1, size) + place] = raw
    return out.tobytes()


def _smaller_elsewhere(texts: Iterable[tuple[bytes, np.ndarray]], window: int) -> np.ndarray:
    """For suffixes of one group, with their documents: does a smaller document have the same window?

    The trees are built from the top. A node is a run of suffixes with the same words so
    far; it is split by the next word, and a node with one leaf is left. Suffixes with
    the same line of text are one leaf, whose text is held once; words are compared through numbers
    that stand for the distinct words of the group.
    """
    numbers: dict[bytes, int] = {}
    leaves, owners = [], []
    for text, owner in texts:
        lines = text.split(b"\n")
        lines.pop()
        leaves.append(np.fromiter((numbers.setdefault(line, len(numbers)) for line in lines), np.int32, len(lines)))
        owners.append(owner)
    if not leaves:
        return np.zeros(0, bool)
    leaf, owner, distinct = np.concatenate(leaves), np.concatenate(owners), list(numbers)
    least = np.full(len(distinct), LAST)
    np.minimum.at(least, leaf, owner)
    del numbers, leaves, owners
    number = _word_numbers(distinct, window)
    at = np.arange(len(distinct))
    node = np.zeros(len(distinct), np.int64)
    del distinct
    for level in range(window):
        if not len(at):
            break
        order = np.lexsort((number[at, level], node))
        at, node = at[order], node[order]
        word = number[at, level]
        new = np.concatenate([[True], (node[1:] != node[:-1]) | (word[1:] != word[:-1])])
        node = np.cumsum(new) - 1
        shared = np.bincount(node)[node] > 1
        at, node = at[shared], node[shared]
    if len(at):
        begin = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        least[at] = np.repeat(np.minimum.reduceat(least[at], begin), np.diff([*begin, len(at)]))
    return owner > least[leaf]


def _word_numbers(lines: list[bytes], window: int) -> np.ndarray:
    """For each line the numbers of its words, taken in blocks: only distinct words are held."""
    numbers: dict[bytes, int] = {}
    out = np.empty((len(lines), window), np.int32)
    for at in range(0, len(lines), 4096):
        words = b" ".join(lines[at : at + 4096]).split()
        out[at : at + 4096].flat = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int32, len(words))
    return out


def _removed(found: Slice, smaller: np.ndarray) -> np.ndarray:
    """Which words go: those in a window that starts in a smaller document, of this slice or another."""
    gone = smaller[found.of] | (found.owner > found.least[found.of])
    steps = np.zeros(len(found.words) + 1, np.int64)
    at = found.starts[gone]
    np.add.at(steps, at, 1)
    np.add.at(steps, at + found.window, -1)
    return np.cumsum(steps)[: len(found.words)] > 0


def _with_answers(docs: DataFrame, window: int, id_column: str) -> tuple[DataFrame, int, np.ndarray, int]:
    """The slices with the filter's bits and the trees' answers, and what reads these."""
    stored, windows, buckets = _sliced(docs, window, id_column)
    parts = max(1, -(-windows // FILTER_PART))
    bits, reported = _filter(stored, window, windows)
    bits = table(bits, "bits")
    split = _split_prefixes(reported)
    groups = max(1, math.ceil(windows / GROUP))
    known = stored.select("slice", "rows").join(bits.repartition(buckets, "slice"), "slice")

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                number, marks = batch.column("slice")[row].as_py(), batch.column("bits")[row].as_py()
                if not any(any(entry["payload"]) for entry in marks):
                    continue
                found = Slice(batch.column("rows")[row].as_py(), window)
                for group, own, at in _suffixes(found, marks, parts, split, groups):
                    raw = len(own).to_bytes(8, "little") + found.least[own].tobytes() + _stretches(found, at)
                    yield _piece(group, number, _press(raw))
                    del raw
                del found
                return_freed_memory()

    suffixes = known.mapInArrow(sent, PIECE_SQL)

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, sizes, group = [], [], None

        def opened() -> Iterator[tuple[bytes, np.ndarray]]:
            nonlocal group
            for batch in batches:
                for row in range(batch.num_rows):
                    group = batch.column("part")[row].as_py()
                    numbers.append(batch.column("slice")[row].as_py())
                    raw = _unpress(batch.column("payload")[row].as_py())
                    count = int.from_bytes(raw[:8], "little")
                    sizes.append(count)
                    yield raw[8 + 8 * count :], np.frombuffer(raw, np.int64, count, 8).copy()

        smaller = _smaller_elsewhere(opened(), window)
        ends = np.cumsum(sizes)
        for number, own in zip(numbers, np.split(smaller, ends[:-1])):
            yield _piece(group, number, np.packbits(own).tobytes())
        return_freed_memory()

    answers = suffixes.repartitionById(groups, F.col("part")).mapInArrow(answered, PIECE_SQL)
    answers = answers.groupBy("slice").agg(F.collect_list(F.struct("part", "payload")).alias("answers"))
    both = bits.join(answers, "slice", "left").repartition(buckets, "slice")
    return stored.select("slice", "rows").join(both, "slice", "left"), parts, split, groups


def _judged(docs: DataFrame, window: int, id_column: str, make, schema) -> DataFrame:
    joined, parts, split, groups = _with_answers(docs, window, id_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                found = Slice(batch.column("rows")[row].as_py(), window)
                smaller = np.zeros(len(found.keys), bool)
                answers = batch.column("answers")[row].as_py()
                if answers:
                    payloads = {entry["part"]: entry["payload"] for entry in answers}
                    marks = batch.column("bits")[row].as_py()
                    for group, own, _ in _suffixes(found, marks, parts, split, groups):
                        marked = np.unpackbits(np.frombuffer(payloads[group], np.uint8), count=len(own)).astype(bool)
                        smaller[own] = marked
                yield make(found, _removed(found, smaller))
                del found
                return_freed_memory()

    return joined.mapInArrow(run, schema)


def _kept_texts(found: Slice, gone: np.ndarray) -> list[bytes]:
    """The words left of each document, joined by one space."""
    words = found.words
    raw, out = words.data.tobytes(), []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        left = np.flatnonzero(~gone[a:b]) + a
        out.append(b" ".join([raw[s:e] for s, e in zip(words.start[left].tolist(), words.end[left].tolist())]))
    return out


def digests(docs: DataFrame, window: int) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and the hash of the kept words, one row for each document."""

    def make(found: Slice, gone: np.ndarray) -> pa.RecordBatch:
        counts = found.words.counts().astype(np.int64)
        removed = np.bincount(found.words.doc[gone], minlength=len(counts)).astype(np.int64)
        hashes = [hashlib.sha256(text).hexdigest() for text in _kept_texts(found, gone)]
        ids = found.table["doc_id"].combine_chunks()
        return pa.RecordBatch.from_arrays([ids, pa.array(counts), pa.array(removed), pa.array(hashes)], names)

    names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return _judged(docs.select("doc_id", "text"), window, "doc_id", make, schema)


def drop_repeats(docs: DataFrame, window: int) -> DataFrame:
    """``docs`` with every text that repeats a smaller document cut.

    A text of which nothing is removed stays as it is; of others the kept words are
    joined by one space.
    """
    from pyspark.sql.types import StringType, StructField, StructType

    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    fields = [StructField("doc_id", docs.schema["doc_id"].dataType), StructField("text", StringType())]
    kind = StructType([docs.schema[c] for c in rest])
    schema = StructType([*fields, StructField("rest", kind)]) if rest else StructType(fields)

    def make(found: Slice, gone: np.ndarray) -> pa.RecordBatch:
        changed = np.bincount(found.words.doc[gone], minlength=found.table.num_rows) > 0
        whole_texts = found.table["text"].to_pylist()
        texts = _kept_texts(found, gone)
        nulls = found.table["null_text"].to_pylist()
        out = [None if null else (new if cut else old).decode() for null, cut, new, old in zip(nulls, changed, texts, whole_texts)]
        columns = [found.table["doc_id"].combine_chunks(), pa.array(out, pa.string())]
        if rest:
            columns.append(found.table["rest"].combine_chunks())
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "rest"][: len(columns)])

    found = _judged(docs, window, "doc_id", make, schema)
    columns = [F.col(c) if c in ("doc_id", "text") else F.col("rest")[c].alias(c) for c in docs.columns]
    return found.select(*columns)
