"""An interpolated modified Kneser-Ney model, counted in Spark and mapped by workers.

Words are told apart by 64-bit hashes. A first job counts them and numbers those of each
shard by falling count, so that frequent words have small numbers. Tasks then count the
n-grams of their texts, as numbers, and send them to the shard of their context (the
words before the last), sorted and compressed. There the counts are added and the
context's sums taken; each distinct n-gram adds one to the continuation count of its
shorter one, which goes on to the next order's shards.

A context of frequent words only would fill a shard: its n-grams are dealt out by all
their words instead, and its sums are added in shards of their own. What words are
frequent is known from the first job.

A shard is a file in the shared folder. It has the contexts as a sorted set of numbers,
and the n-grams as a set of (place of the context, last word); of a number only the bits
that its place in the set leaves open are stored. Workers map the files and look the
n-grams of many documents up in them.

The number of shards follows the text's size, so a shard's memory does not grow. The
driver gets a few rows of paths and totals for each shard.

Each text is read as ``order - 1`` starts, its words in lower case (A to Z), and an end,
which counts as a token. Null texts are empty and have that one token.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.folders import SharedWriter, mapped, shared_folder
from recordloom.llm.text import Words, buffers, lower, mix, return_freed_memory, slices, span_hashes, utf8

START, END = np.uint64(0x5354415254), np.uint64(0x454E44)
_STEP = np.uint64(0x9E3779B97F4A7C15)

#: Bytes of text for each shard, n-grams that a task counts before it sends them.
SHARD_BYTES, HELD = 16 << 20, 2_500_000
#: Counts from this on are stored apart, so that a count is one byte.
LARGE = 255
#: Bytes of text of a shard for each time that a frequent word occurs at least.
HOT_BYTES = 8


def sequences(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all documents' tokens with starts and ends; places and documents of the tokens proper."""
    words = Words(lower(data), offsets)
    docs, starts = len(offsets) - 1, order - 1
    counts = words.counts()
    tokens = np.full(len(words) + docs * order, START)
    begin = words.first[:-1] + np.arange(docs) * order
    at = begin[words.doc] + starts + np.arange(len(words)) - words.first[words.doc]
    tokens[at] = span_hashes(words.data, words.start, words.end)
    ends = begin + starts + counts
    tokens[ends] = END
    proper = np.ones(len(tokens), bool)
    for k in range(starts):
        proper[begin + k] = False
    places = np.flatnonzero(proper)
    return tokens, places, np.repeat(np.arange(docs), counts + 1)


def joined(columns: list[np.ndarray], bits: int) -> np.ndarray:
    """One number for each row: its columns of ``bits`` bits side by side, or a hash where that exceeds 64."""
    fits, out = len(columns) * bits <= 64, columns[0].copy()
    for column in columns[1:]:
        out = out << np.uint64(bits) | column if fits else mix(out * _STEP + column)
    return out


def shard_of(key: np.ndarray, shards: int) -> np.ndarray:
    return ((mix(key) >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _changes(columns: list[np.ndarray]) -> np.ndarray:
    """Which rows differ from the row before them."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for column in columns:
        out[1:] |= column[1:] != column[:-1]
    return out


def _in_order(columns: list[np.ndarray]) -> bool:
    same = np.ones(max(0, len(columns[0]) - 1), bool)
    for column in columns:
        if (same & (column[1:] < column[:-1])).any():
            return False
        same &= column[1:] == column[:-1]
    return True


def _sorting(columns: list[np.ndarray], bits: int) -> np.ndarray:
    """The order of rows by their columns, of ``bits`` bits each: by those that fit 64 bits, then rows equal in them by the others."""
    fits = 64 // bits
    code = joined(columns[:fits], bits)
    order = np.argsort(code)
    if len(columns) <= fits or not len(order):
        return order
    first, rows = _changes([code[order]]), len(order).bit_length()
    for column in columns[fits:]:
        some = np.flatnonzero(~(first & np.append(first[1:], True)))
        equal, width = order[some], bits
        own, run = column[equal], np.cumsum(first, dtype=np.uint64)[some]
        if rows + bits > 64:
            own, width = np.unique(own, return_inverse=True)[1].astype(np.uint64), rows
        code = run << np.uint64(width) | own
        by = np.argsort(code)
        order[some] = equal[by]
        first[some] |= _changes([code[by]])
    return order


def added(columns: list[np.ndarray], values: list[np.ndarray], bits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """One row for each distinct n-gram, in order, with its values added."""
    order = _sorting(columns, bits)
    columns = [c[order] for c in columns]
    first = np.flatnonzero(_changes(columns))
    return [c[first] for c in columns], [np.add.reduceat(v[order], first) for v in values] if len(first) else values


def counted_rows(columns: list[np.ndarray], bits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """One row for each distinct n-gram, in order, with the number of its rows."""
    if len(columns) * bits > 64:
        return added(columns, [np.ones(len(columns[0]), np.uint64)], bits)
    code = joined(columns, bits)
    code.sort()
    first = np.flatnonzero(_changes([code]))
    counts = np.diff(first, append=len(code)).astype(np.uint64)
    code, low = code[first], np.uint64((1 << bits) - 1)
    return [code >> np.uint64(bits * k) & low for k in range(len(columns) - 1, -1, -1)], [counts]


def _planes(values: np.ndarray) -> bytes:
    """The bytes of numbers by their place, as many as the greatest has; their number comes first."""
    width = -(-int(values.max(initial=0)).bit_length() // 8)
    return bytes([width]) + values.astype(np.uint64).view(np.uint8).reshape(-1, 8).T[:width].tobytes()


def _pack(parts: list[np.ndarray], words: int) -> bytes:
    """Arrays, of which the first ``words`` are an n-gram's words, with its rows in any order.

    They are sent in the order of the words. A word is sent as its difference from the one
    above it where those before it are the same. Without words the first array is sorted
    and sent as differences.
    """
    if words:
        bits = max(1, *(int(c.max(initial=0)).bit_length() for c in parts[:words]))
        if not _in_order(parts[:words]):
            order = _sorting(parts[:words], bits)
            parts = [p[order] for p in parts]
    sent, start = [], np.zeros(len(parts[0]), bool)
    start[:1] = True
    for column in parts[: words or 1]:
        sent.append(np.where(start, column, np.diff(column, prepend=np.uint64(0))))
        start |= _changes([column])
    raw = [np.array([len(parts[0])], np.uint64).tobytes(), *map(_planes, [*sent, *parts[words or 1 :]])]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(raw))


def _unpack(payload: bytes, count: int, words: int) -> list[np.ndarray]:
    """The ``count`` arrays that were packed, their rows in the order they were sent in."""
    raw = zstandard.ZstdDecompressor().decompress(payload)
    rows = int(np.frombuffer(raw, np.uint64, 1)[0])
    parts, at = [], 8
    for _ in range(count):
        width = raw[at]
        planes = np.zeros((rows, 8), np.uint8)
        planes[:, :width] = np.frombuffer(raw, np.uint8, width * rows, at + 1).reshape(width, rows).T
        parts.append(planes.view(np.uint64).ravel())
        at += 1 + width * rows
    start = np.zeros(rows, bool)
    start[:1] = True
    for k in range(words or 1):
        firsts = np.flatnonzero(start)
        sums = np.cumsum(parts[k], dtype=np.uint64)
        parts[k] = sums - np.repeat(sums[firsts] - parts[k][firsts], np.diff(firsts, append=rows))
        start |= _changes([parts[k]])
    return parts


#: What a row holds: counted words or n-grams, sums of contexts, the path of a file of either.
GRAMS, SUMS, GRAM_FILE, SUM_FILE = range(4)
ROW = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("level", pa.int32()), ("payload", pa.binary()), ("path", pa.string()), ("totals", pa.list_(pa.int64()))])
ROW_SQL = "shard int, kind int, level int, payload binary, path string, totals array<long>"


def _row(**values) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{**dict.fromkeys(ROW.names), **values}], ROW)


def _dealt(parts: list[np.ndarray], shard: np.ndarray, kind: int, words: int) -> Iterator[pa.RecordBatch]:
    """A row for each shard with its part of the arrays (in their order, so sorted ones compress)."""
    for k, own in _by_shard(shard):
        yield _row(shard=k, kind=kind, payload=_pack([p[own] for p in parts], words))


def _by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard and the places of its rows, in their order."""
    if not len(shard):
        return
    most = int(shard.max())
    if most < 1 << 16:
        shard = shard.astype(np.uint16)  # which numpy sorts by counting
    order = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[order], np.arange(most + 2))
    for k in np.flatnonzero(np.diff(cuts)):
        yield int(k), order[cuts[k] : cuts[k + 1]]


class Payloads:
    """Payloads of one kind; they are added up whenever they have doubled."""

    def __init__(self, words: int, values: int, bits: int):
        self.words, self.values, self.bits = words, values, bits
        self.held, self.rows, self.least = [], 0, 0

    def put(self, payload: bytes) -> None:
        self.held.append(_unpack(payload, self.words + self.values, self.words))
        self.rows += len(self.held[-1][0])
        if self.rows >= 2 * self.least + HELD:
            columns, values = self.merged()
            self.held = [[*columns, *values]]
            self.rows = self.least = len(columns[0])

    def merged(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        parts = [np.concatenate([h[k] for h in self.held]) for k in range(self.words + self.values)]
        self.held = []
        return added(parts[: self.words], parts[self.words :], self.bits)


@dataclass
class Numbers:
    """What words' numbers are: 0 a start, then 1 + rank * shards + shard; ``limit`` an unknown word."""

    shards: int
    paths: list[str | None]
    limit: int = 1
    hot: np.ndarray = field(default_factory=lambda: np.zeros(1, np.uint64))  # ranks below are frequent words, by shard

    @property
    def bits(self) -> int:
        return self.limit.bit_length()

    def frequent(self, ids: np.ndarray) -> np.ndarray:
        """Which numbers are a start or frequent words."""
        out = ids <= self.hot.max() * np.uint64(self.shards)
        some = np.flatnonzero(out & (ids > 0))
        rank, shard = np.divmod(ids[some] - np.uint64(1), np.uint64(self.shards))
        out[some] = rank < self.hot[shard.astype(np.int64)]
        return out

    def dealt(self, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The shard of each n-gram, and whether it is dealt by all its words."""
        if len(columns) == 1:
            return shard_of(columns[0], self.shards), np.zeros(len(columns[0]), bool)
        shard = shard_of(joined(columns[:-1], self.bits), self.shards)
        hot = self.frequent(columns[0])
        for column in columns[1:-1]:
            some = np.flatnonzero(hot)
            hot[some] = self.frequent(column[some])
        some = np.flatnonzero(hot)
        shard[some] = shard_of(joined([c[some] for c in columns], self.bits), self.shards)
        return shard, hot


@dataclass
class Level:
    """One order of a model."""

    paths: list[str | None] = field(default_factory=list)  # by shard of the n-gram
    sums: list[str | None] = field(default_factory=list)  # of contexts of frequent words, by shard of the context
    discounts: tuple[float, float, float] = (0.5, 1.0, 1.5)


@dataclass
class Model:
    order: int
    shards: int
    levels: dict[int, Level]
    numbers: Numbers
    tokens: int = 0  # of the training texts
    words: int = 0  # distinct, ends included
    unigram: tuple[int, float] = (0, 0.0)  # sum of continuation counts, mass for unseen words


def discounts(counts: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from how many n-grams occur 1, 2, 3 and 4 times."""
    n1, n2, n3, n4 = counts
    if not (n1 and n2 and n3):
        return (0.5, 1.0, 1.5)
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return found if all(0 < d < k + 1 for k, d in enumerate(found)) else (0.5, 1.0, 1.5)


def train(docs: DataFrame, order: int = 3) -> Model:
    """Count the texts of ``docs`` and store the model in the shared folder."""
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(1, -(-size // SHARD_BYTES))
    folder = shared_folder(spark, "ngrams")
    texts = docs.select(utf8("text").alias("text"))
    numbers = Numbers(shards, [None] * shards, hot=np.zeros(shards, np.uint64))
    model = Model(order, shards, {n: Level([None] * shards, [None] * shards) for n in range(1, order + 1)}, numbers)
    for row in _numbered(texts, shards, folder, SHARD_BYTES // HOT_BYTES).select("shard", "path", "totals").collect():
        distinct, tokens, hot = row.totals
        numbers.paths[row.shard] = row.path
        numbers.hot[row.shard] = hot
        numbers.limit = max(numbers.limit, distinct * shards + 1)
        model.words += distinct
        model.tokens += tokens

    built = _counted(texts, order, numbers)
    for n in range(order, 0, -1):
        built = _built(built, n, order, numbers, folder)
    totals = np.zeros((order + 1, 7), np.int64)
    for row in built.select("shard", "kind", "level", "path", "totals").collect():
        if row.kind == SUM_FILE:
            model.levels[row.level].sums[row.shard] = row.path
        else:
            model.levels[row.level].paths[row.shard] = row.path
            totals[row.level] += row.totals
    for n, level in model.levels.items():
        level.discounts = discounts(totals[n, :4].tolist())
    mass = sum(d * t for d, t in zip(model.levels[1].discounts, totals[1, [0, 1, 4]].tolist()))
    model.unigram = (int(totals[1, 6]), mass)
    return model


def _numbered(texts: DataFrame, shards: int, folder: str, frequent: int) -> DataFrame:
    """Each shard's file of words, with their ranks and counts; totals are its words, tokens and frequent words."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def sent():
            columns, values = added([np.concatenate([h[0] for h in held])], [np.concatenate([h[1] for h in held])], 64)
            yield from _dealt([*columns, *values], shard_of(columns[0], shards), GRAMS, 1)

        for batch in slices(batches, "text"):
            (words,), (counts,) = counted_rows([sequences(*buffers(batch.column("text")), 1)[0]], 64)
            held.append((words, counts))
            rows += len(words)
            if rows >= HELD:
                yield from sent()
                held, rows = [], 0
        if rows:
            yield from sent()

    def stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, shard = Payloads(1, 1, 64), None
        for batch in batches:
            for row in batch.to_pylist():
                shard = row["shard"]
                words.put(row["payload"])
        if shard is not None:
            (key,), (count,) = words.merged()
            rank = np.empty(len(key), np.uint32)
            rank[np.argsort(~count, kind="stable")] = np.arange(len(key), dtype=np.uint32)
            path = _written(folder, f"words-{shard:06d}", [key, rank, *_small(count)])
            yield _row(shard=shard, path=path, totals=[len(key), int(count.sum()), int((count >= frequent).sum())])

    sent = texts.mapInArrow(counted, ROW_SQL).select("shard", "payload")
    return sent.repartitionById(shards, F.col("shard")).mapInArrow(stored, ROW_SQL)


def _counted(texts: DataFrame, order: int, numbers: Numbers) -> DataFrame:
    """Rows of counted n-grams for the shards of the highest order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, rows = Numbering(numbers), [], 0

        def sent():
            columns = [np.concatenate([h[k] for h in held]) for k in range(order)]
            held.clear()
            columns, values = counted_rows(columns, numbers.bits)
            yield from _dealt([*columns, *values], numbers.dealt(columns)[0], GRAMS, order)

        for batch in slices(batches, "text"):
            tokens, places, _ = sequences(*buffers(batch.column("text")), order)
            ids = words.ids(tokens)[0]
            held.append([ids[places - order + 1 + k] for k in range(order)])
            rows += len(places)
            if rows >= HELD:
                yield from sent()
                rows = 0
        if rows:
            yield from sent()
        return_freed_memory()

    return texts.mapInArrow(run, ROW_SQL)


def _built(sent: DataFrame, n: int, order: int, numbers: Numbers, folder: str) -> DataFrame:
    """Each shard's file of order ``n``, its n-grams for the order below, and sums of contexts that lie in several shards.

    Paths of the files of higher orders are passed on.
    """
    bits = numbers.bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, sums, shard = Payloads(n, 1, bits), Payloads(n, 4, bits), None
        for batch in batches:
            for row in batch.to_pylist():
                shard = row["shard"]
                if row["kind"] == GRAMS:
                    grams.put(row["payload"])
                elif row["kind"] == SUMS:
                    sums.put(row["payload"])
                else:
                    yield _row(**row)
        if sums.held:
            columns, values = sums.merged()
            arrays, place = _set(joined(columns, bits), _width(n, bits))
            path = _written(folder, f"sums-{n + 1}-{shard:06d}", [*arrays, *_small_sums([v[place] for v in values])])
            yield _row(shard=shard, kind=SUM_FILE, level=n + 1, path=path)
        if not grams.held:
            return
        columns, (count,) = grams.merged()
        times = [int((count == k).sum()) for k in (1, 2, 3, 4)]
        totals = [*times, int((count > 2).sum()), len(count), int(count.sum())]
        if n == 1:
            arrays, place = _set(columns[0], bits)
        else:
            context, lengths, values = _context_sums(columns, count)
            hot = np.flatnonzero(numbers.dealt([*context, context[0]])[1])
            some = [c[hot] for c in context]
            own = shard_of(joined(some, bits), numbers.shards)
            yield from _dealt([*some, *(v[hot] for v in values)], own, SUMS, n - 1)
            contexts, place = _set(joined(context, bits), _width(n - 1, bits))
            at = np.empty(len(place), np.uint64)
            at[place] = np.arange(len(place), dtype=np.uint64)
            contexts += _small_sums([v[place] for v in values])
            key = np.repeat(at, lengths) << np.uint64(bits) | columns[-1]
            arrays, place = _set(key, len(at).bit_length() + bits)
            shorter, values = counted_rows(columns[1:], bits)
            yield from _dealt([*shorter, *values], numbers.dealt(shorter)[0], GRAMS, n - 1)
        stored = [*arrays, *_small(count[place])]
        path = _written(folder, f"order-{n}-{shard:06d}", stored if n == 1 else [*contexts, *stored])
        yield _row(shard=shard, kind=GRAM_FILE, level=n, path=path, totals=totals)
        return_freed_memory()

    rows = sent.repartitionById(numbers.shards, F.col("shard"))
    return rows.mapInArrow(run, ROW_SQL)


def _context_sums(columns: list[np.ndarray], count: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, list[np.ndarray]]:
    """Contexts of sorted n-grams, how many each has, and their sums of counts and how many words followed once, twice and more often."""
    first = np.flatnonzero(_changes(columns[:-1]))
    times = [np.add.reduceat(x, first, dtype=np.uint64) for x in (count == 1, count == 2, count > 2)]
    return [c[first] for c in columns[:-1]], np.diff(first, append=len(count)), [np.add.reduceat(count, first), *times]


def _written(folder: str, label: str, arrays: list[np.ndarray]) -> str:
    """Write a header with the arrays' sizes and those of their elements, then the arrays, each from a multiple of 8 bytes on."""
    writer = SharedWriter(folder, label)
    header = np.array([len(arrays), *(x for a in arrays for x in (a.nbytes, a.itemsize))], np.uint64)
    writer.write(header.tobytes())
    for a in arrays:
        writer.write(a.tobytes() + b"\0" * (-a.nbytes % 8))
    writer.close()
    return writer.path


def _arrays(path: str) -> list[np.ndarray]:
    """A file's arrays, mapped."""
    raw = mapped(path)
    count = int(np.frombuffer(raw, np.uint64, 1)[0])
    header, at, arrays = np.frombuffer(raw, np.uint64, 2 * count, 8).tolist(), 8 + 16 * count, []
    for size, item in zip(header[::2], header[1::2]):
        arrays.append(np.frombuffer(raw, f"u{item}", size // item, at))
        at += size + -size % 8
    return arrays


def _small(count: np.ndarray) -> list[np.ndarray]:
    """Counts of one byte, large ones apart."""
    large = np.flatnonzero(count >= LARGE)
    return [np.minimum(count, LARGE).astype(np.uint8), large.astype(np.uint32), count[large]]


def _counts(small: np.ndarray, large: np.ndarray, large_count: np.ndarray, at: np.ndarray) -> np.ndarray:
    count = small[at].astype(np.int64)
    big = np.flatnonzero(count == LARGE)
    count[big] = large_count[np.searchsorted(large, at[big].astype(large.dtype))]
    return count


#: A context's byte: 4 bits of words that followed once, 4 of those that followed twice; or this, and its sums are stored apart.
APART = 255


def _small_sums(values: list[np.ndarray]) -> list[np.ndarray]:
    _, once, twice, more = values
    apart = (more > 0) | (once > 15) | (twice > 14)
    large = np.flatnonzero(apart)
    small = np.where(apart, np.uint64(APART), twice << np.uint64(4) | once).astype(np.uint8)
    return [small, large.astype(np.uint32), np.stack([v[large] for v in values], axis=1).ravel()]


#: Sums of counts, and how many words followed once, twice and more often, by a context's byte.
_SUMS = np.array([[(k & 15) + 2 * (k >> 4), k & 15, k >> 4, 0] for k in range(256)], float)


def _sums(small: np.ndarray, large: np.ndarray, large_sums: np.ndarray, at: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sum of counts at each place, and the sum of the weights of the words that followed once, twice and more often."""
    code = small[at]
    seen, mass = _SUMS[:, 0][code], (_SUMS[:, 1:] @ weights)[code]
    big = np.flatnonzero(code == APART)
    apart = large_sums.reshape(-1, 4)[np.searchsorted(large, at[big].astype(large.dtype))].astype(float)
    seen[big], mass[big] = apart[:, 0], apart[:, 1:] @ weights
    return seen, mass


def _width(words: int, bits: int) -> int:
    """Bits of ``joined`` numbers of so many words."""
    return words * bits if words * bits <= 64 else 64


def _spread(key: np.ndarray, width: int) -> np.ndarray:
    """Numbers of ``width`` bits spread over all such numbers (a bijection)."""
    low, half = np.uint64((1 << width) - 1), np.uint64(max(1, width // 2))
    out = key * _STEP & low
    out ^= out >> half
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out &= low
    out ^= out >> half
    return out


#: The bytes of two arrays that hold a set's rest, by the bytes it needs.
_PARTS = {0: (1, 0), 1: (1, 0), 2: (2, 0), 3: (2, 1), 4: (4, 0), 5: (4, 1), 6: (4, 2), 7: (8, 0), 8: (8, 0)}


def _set(key: np.ndarray, width: int) -> tuple[list[np.ndarray], np.ndarray]:
    """A set's arrays, and the places of the keys in its order.

    The spread keys are sorted. Their high bits choose a bucket, of which the start is
    stored; of a key only the rest is stored.
    """
    spread = _spread(key, width)
    order = np.argsort(spread)
    spread = spread[order]
    least = max(1, len(key).bit_length() - 4)
    _, high = min((len(key) * sum(_PARTS[-(-(width - d) // 8)]) + (4 << d), d) for d in range(least, least + 4) if d <= width)
    rest = np.uint64(width - high)
    starts = np.searchsorted(spread >> rest, np.arange((1 << high) + 1, dtype=np.uint64)).astype(np.uint32)
    one, two = _PARTS[-(-(width - high) // 8)]
    spread &= np.uint64((1 << (width - high)) - 1)
    spread = np.append(spread, np.uint64(0))  # so that a place after the last key can be read
    parts = [(spread >> np.uint64(8 * two)).astype(f"u{one}"), (spread & np.uint64((1 << 8 * two) - 1)).astype(f"u{two or 1}")[: None if two else 0]]
    return [np.array([width, high], np.uint64), starts, *parts], order


class Set:
    """A set of numbers in a file."""

    def __init__(self, shape: np.ndarray, starts: np.ndarray, one: np.ndarray, two: np.ndarray):
        self.width, high = shape.tolist()
        self.rest = np.uint64(self.width - high)
        self.low = np.uint64((1 << (self.width - high)) - 1)
        self.starts, self.one, self.two = starts, one, two
        self.kind = np.uint32 if self.width - high <= 32 else np.uint64
        self.shift = self.kind(8 * two.itemsize)

    def _at(self, place: np.ndarray) -> np.ndarray:
        one = self.one[place].astype(self.kind, copy=False)
        return one << self.shift | self.two[place] if len(self.two) else one

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are in the set, and their places."""
        spread = _spread(keys, self.width)
        bucket, wanted = (spread >> self.rest).astype(np.int64), (spread & self.low).astype(self.kind)
        low, ends = self.starts[bucket].astype(np.int64), self.starts[bucket + 1].astype(np.int64)

        def halved(low: np.ndarray, high: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            middle = low + high >> 1
            less = (self._at(middle) < wanted) & (low < high)
            return np.where(less, middle + 1, low), np.where(less, high, middle)

        high = ends
        for _ in range(3):  # enough for most buckets
            low, high = halved(low, high, wanted)
        some = np.flatnonzero(low < high)
        while len(some):
            low[some], high[some] = halved(low[some], high[some], wanted[some])
            some = some[low[some] < high[some]]
        there = np.flatnonzero((low < ends) & (self._at(low) == wanted))
        return there, low[there]


class Shard:
    """A shard's n-grams and their contexts."""

    def __init__(self, path: str):
        *contexts, shape, starts, one, two, small, large, counts = _arrays(path)
        self.grams, self._counts = Set(shape, starts, one, two), (small, large, counts)
        if contexts:
            self.contexts, self._sums = Set(*contexts[:4]), contexts[4:]

    def counts(self, at: np.ndarray) -> np.ndarray:
        return _counts(*self._counts, at)

    def sums(self, at: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _sums(*self._sums, at, weights)


class Sums:
    """Sums of contexts of frequent words."""

    def __init__(self, path: str):
        arrays = _arrays(path)
        self.contexts, self._sums = Set(*arrays[:4]), arrays[4:]

    def sums(self, at: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _sums(*self._sums, at, weights)


class Numbering:
    """Numbers and counts of words, found by their hashes in files that are opened when first needed."""

    def __init__(self, numbers: Numbers):
        self.numbers = numbers
        self._open: dict[int, list[np.ndarray]] = {}

    def ids(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each token's number and count."""
        numbers = self.numbers
        listed, place = np.unique(tokens, return_inverse=True)
        ids, counts = np.full(len(listed), numbers.limit, np.uint64), np.zeros(len(listed), np.int64)
        for k, own in _by_shard(shard_of(listed, numbers.shards)):
            if numbers.paths[k] is None:
                continue
            if k not in self._open:
                self._open[k] = _arrays(numbers.paths[k])
            key, rank, *small = self._open[k]
            at = np.minimum(np.searchsorted(key, listed[own]), len(key) - 1)
            there = np.flatnonzero(key[at] == listed[own])
            own, at = own[there], at[there]
            ids[own] = rank[at].astype(np.uint64) * np.uint64(numbers.shards) + np.uint64(k + 1)
            counts[own] = _counts(*small, at)
        ids[listed == START] = 0
        return ids[place], counts[place]


class Reader:
    """A model's files, opened when a text first needs them."""

    def __init__(self, model: Model):
        self.model, self.words = model, Numbering(model.numbers)
        self._open: dict[str, Shard | Sums] = {}

    def _file(self, path: str | None, opened):
        if path is not None and path not in self._open:
            self._open[path] = opened(path)
        return self._open.get(path)

    def probabilities(self, tokens: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The probability of each token after those before it, and its plain count in training."""
        model, numbers = self.model, self.model.numbers
        ids, plain = self.words.ids(tokens)
        plain = plain[places]
        total, mass = model.unigram
        even = 1 / (model.words + 1)
        if not total:
            return np.full(len(places), even), plain
        last = ids[places]
        count = np.zeros(len(places), np.int64)
        for k, own in _by_shard(shard_of(last, numbers.shards)):
            if shard := self._file(model.levels[1].paths[k], Shard):
                there, at = shard.grams.find(last[own])
                count[own[there]] = shard.counts(at)
        found = (self._less(count, 1) + mass * even) / total
        for n in range(2, model.order + 1):
            count, seen, mass = self._level(n, [ids[places - n + 1 + k] for k in range(n)])
            found = np.where(seen > 0, (self._less(count, n) + mass * found) / np.maximum(seen, 1), found)
        return found, plain

    def _level(self, n: int, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The counts of n-grams, and of their contexts the sum of counts and the discounts' mass."""
        level, numbers = self.model.levels[n], self.model.numbers
        count, seen, mass = np.zeros(len(columns[0]), np.int64), np.zeros(len(columns[0])), np.zeros(len(columns[0]))
        context, weights = joined(columns[:-1], numbers.bits), np.array(level.discounts)
        dealt, hot = numbers.dealt(columns)
        for k, own in _by_shard(dealt):
            if shard := self._file(level.paths[k], Shard):
                there, at = shard.contexts.find(context[own])
                own = own[there]
                seen[own], mass[own] = shard.sums(at, weights)
                there, at = shard.grams.find(at.astype(np.uint64) << np.uint64(numbers.bits) | columns[-1][own])
                count[own[there]] = shard.counts(at)
        hot = np.flatnonzero(hot)
        seen[hot] = 0  # a shard has but a part of these
        for k, own in _by_shard(shard_of(context[hot], numbers.shards)):
            if file := self._file(level.sums[k], Sums):
                there, at = file.contexts.find(context[hot[own]])
                own = hot[own[there]]
                seen[own], mass[own] = file.sums(at, weights)
        return count, seen, mass

    def _less(self, count: np.ndarray, n: int) -> np.ndarray:
        """Counts less their discount."""
        return count - np.array([0.0, *self.model.levels[n].discounts])[np.minimum(count, 3)]


SCHEMA = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """log10 probabilities of every text: by the model, and by add-one single words for comparison."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in slices(batches, "text"):
            tokens, places, doc = sequences(*buffers(batch.column("text")), model.order)
            probability, count = reader.probabilities(tokens, places)
            docs_here = batch.num_rows
            n = np.bincount(doc, minlength=docs_here)
            base = np.log10(count + 1) - np.log10(float(model.tokens + model.words + 1))
            total = np.bincount(doc, np.log10(probability), docs_here)
            columns = [
                n,
                np.bincount(doc, count > 0, docs_here).astype(np.int64),
                np.full(docs_here, model.tokens),
                np.bincount(doc, base, docs_here),
                total,
                10 ** np.minimum(-total / n, 300),
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, columns)], names)

    names = [f.split()[0] for f in SCHEMA.split(", ")]
    return plain.mapInArrow(run, SCHEMA)
