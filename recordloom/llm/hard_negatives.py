"""Hard negatives by rotated one-bit codes whose intervals decide what is scored.

A vector x is turned by one random rotation; its code keeps the signs, o' (a unit vector of
+-1/sqrt(width)). Stored beside the code are the length |x| and the alignment a = <o, o'> of
o = x / |x| with its own code. For an anchor q, turned likewise, ``<q, o>`` is ``a <q, o'>`` and a
rest in which only the parts of q and o across o' meet, so by Cauchy-Schwarz

    |<q, o> - a c| <= sqrt(|q|^2 - c^2) sqrt(1 - a^2),   c = <q, o'>.

c comes from popcounts: q is rounded to a few bits for each component, and a plane of these bits
meets a code in one AND. What the rounding can change is known too and widens the interval, so
that it always holds the true product. Rows whose interval can't reach an anchor's results are
passed over; all others are scored by integers, and only these scores decide.

The rows' table (vector, code, length, alignment) is written once and never moved: the anchors, a
stated share of the rows, are written as files of ``GROUP`` anchors, and every task takes its rows
past each of these files, one at a time. Only the best of each task leave it. A bounded sample of
rows gives each anchor a first bound from below; it steers the work and decides nothing.

Defined results: rows with a null id, label or vector take no part, nor do vectors that hold
a null, NaN or infinity (``knn.quantized`` makes them null). Vectors are multiplied over the width
of the longest, shorter ones as if filled with zeros. Rows that repeat are candidates each;
an anchor id that repeats is one anchor (its least label and vector). Rows with the anchor's
id are neither its positives nor its negatives. Empty tables give empty results. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm.folders import open_input, table
from recordloom.llm.knn import _matrix, _products
from recordloom.sources.scratch import scratch_path

#: Anchors of a file, and rows compared with them at once.
GROUP, CHUNK = 1024, 1024
#: Bits to which an anchor's components are rounded.
PLANES = 6
#: Sampled rows for the first bounds.
SAMPLE = 2048

LEAST = -(2**63)
INDEX = "vec_id long, label long, vector array<long>, code array<long>, length double, alignment double"
SCORED = "anchor_id long, slot int, vec_id long, score long"


def rotation(width: int) -> np.ndarray:
    """A random rotation, always the same for a width."""
    drawn = np.random.default_rng(1234).standard_normal((width, width))
    return np.linalg.qr(drawn)[0]


def encode(matrix: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (64 signs to a word), lengths and alignments of the rows."""
    width = len(turn)
    turned = matrix.astype(np.float64) @ turn.T
    length = np.sqrt((turned * turned).sum(axis=1))
    alignment = np.abs(turned).sum(axis=1) / np.maximum(length, 1e-300) / np.sqrt(width)
    return pack(turned >= 0), length, np.minimum(alignment, 1.0)


def pack(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    words = -(-bits.shape[1] // 64)
    padded = np.zeros((len(bits), 64 * words), bool)
    padded[:, : bits.shape[1]] = bits
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


class Anchors:
    """Turned and rounded anchors, which tell the intervals of their products with coded rows."""

    def __init__(self, matrix: np.ndarray, turn: np.ndarray):
        self.width = len(turn)
        turned = matrix.astype(np.float64) @ turn.T
        self.length = np.sqrt((turned * turned).sum(axis=1))
        low, high = turned.min(axis=1, initial=0), turned.max(axis=1, initial=0)
        self.step = np.maximum((high - low) / (2**PLANES - 1), 1e-300)
        self.low = low
        levels = np.clip(np.rint((turned - low[:, None]) / self.step[:, None]), 0, 2**PLANES - 1).astype(np.int64)
        rounded = low[:, None] + self.step[:, None] * levels
        self.total = rounded.sum(axis=1)
        # against signs of size 1 / sqrt(width) the rounding changes a product by this at most
        self.rounding = np.abs(turned - rounded).sum(axis=1) / np.sqrt(self.width)
        self.planes = [pack(levels >> k & 1 == 1) for k in range(PLANES)]

    def intervals(self, q: np.ndarray, code: np.ndarray, length: np.ndarray, alignment: np.ndarray):
        """Least and most of the products of the anchors ``q`` with coded rows."""
        agreed = np.zeros((len(q), len(code)), np.int64)
        for k, plane in enumerate(self.planes):
            ones = np.zeros((len(q), len(code)), np.uint16)
            for word in range(code.shape[1]):
                ones += np.bitwise_count(plane[q, word][:, None] & code[None, :, word])
            agreed += ones.astype(np.int64) << k
        positive = np.bitwise_count(code).sum(axis=1, dtype=np.int64)
        # twice the sum over the positive signs, less the sum over all, is the sum with signs
        signed = 2 * (self.low[q][:, None] * positive + self.step[q][:, None] * agreed) - self.total[q][:, None]
        c = signed / np.sqrt(self.width)
        room = self.rounding[q][:, None]
        across = np.sqrt(np.maximum(self.length[q][:, None] ** 2 - np.maximum(np.abs(c) - room, 0) ** 2, 0))
        spread = alignment * room + across * np.sqrt(np.maximum(1 - alignment**2, 0))
        spread = spread + 1e-9 * (self.length[q][:, None] + np.abs(c))  # of the float arithmetic itself
        return (alignment * c - spread) * length, (alignment * c + spread) * length


def best(anchor, slot, ids, scores, k: int):
    """The k highest scores of each anchor and slot, ties to the smaller id."""
    order = np.lexsort((ids, -scores, slot, anchor))
    anchor, slot, ids, scores = anchor[order], slot[order], ids[order], scores[order]
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (slot[1:] != slot[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    kept = np.arange(len(new)) - first < k
    return anchor[kept], slot[kept], ids[kept], scores[kept]


class Results:
    """The k best so far of each anchor and slot; ``floor`` is what a score has to reach."""

    def __init__(self, floor: np.ndarray, k: int):
        self.floor, self.k, self.parts, self.size = floor.astype(np.int64), k, [], 0

    def add(self, anchor, slot, ids, scores) -> None:
        if not len(anchor):
            return
        self.parts.append((anchor, slot, ids, scores))
        self.size += len(anchor)
        if self.size > 4 * self.k * self.floor.size + CHUNK:
            self._settle()

    def _settle(self) -> None:
        self.parts = [best(*(np.concatenate(x) for x in zip(*self.parts)), self.k)]
        anchor, slot, _, scores = self.parts[0]
        self.size = len(anchor)
        full = np.zeros(self.floor.shape, np.int64)
        np.add.at(full, (anchor, slot), 1)
        worst = np.full(self.floor.shape, 2**63 - 1)
        np.minimum.at(worst, (anchor, slot), scores)
        self.floor = np.where(full >= self.k, np.maximum(self.floor, worst), self.floor)

    def rows(self, anchor_ids: np.ndarray) -> pa.RecordBatch | None:
        if not self.parts:
            return None
        self._settle()
        anchor, slot, ids, scores = self.parts[0]
        return pa.RecordBatch.from_arrays(
            [pa.array(anchor_ids[anchor]), pa.array(slot, pa.int32()), pa.array(ids), pa.array(scores)],
            ["anchor_id", "slot", "vec_id", "score"],
        )


def _rows(batch: pa.RecordBatch | pa.Table, width: int):
    code = _matrix(batch.column("code"), -(-width // 64)).view(np.uint64)
    numbers = (batch.column(n).to_numpy() for n in ("vec_id", "label", "length", "alignment"))
    return (*numbers, code, _matrix(batch.column("vector"), width))


def _scored(anchors, rows, q, c):
    """Integer products of the pairs (q, c): dense over the rows and anchors that have any."""
    if not len(q):
        return np.zeros(0, np.int64)
    some_q, at_q = np.unique(q, return_inverse=True)
    some_c, at_c = np.unique(c, return_inverse=True)
    return _products(anchors[some_q], rows[some_c])[at_q, at_c].astype(np.int64)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            yield batch.slice(at, CHUNK)


def _positive_chunk(group: dict, kept: Results, rows, turn) -> None:
    """Rows of the anchors' own labels, label by label."""
    ids, label, length, alignment, code, matrix = rows
    for value in np.intersect1d(label, group["label"]):
        q, c = np.flatnonzero(group["label"] == value), np.flatnonzero(label == value)
        _, most = group["coded"].intervals(q, code[c], length[c], alignment[c])
        open_q, open_c = np.nonzero((most >= kept.floor[q, 0][:, None]) & (group["id"][q][:, None] != ids[c]))
        q, c = q[open_q], c[open_c]
        scores = _scored(group["vector"], matrix, q, c)
        good = scores >= kept.floor[q, 0]
        kept.add(q[good], np.zeros(good.sum(), np.int64), ids[c[good]], scores[good])


def _negative_chunk(group: dict, kept: Results, rows, turn) -> None:
    """Rows of other labels whose interval meets what one of the anchor's positives allows."""
    ids, label, length, alignment, code, matrix = rows
    every = np.arange(len(group["id"]))
    least, most = group["coded"].intervals(every, code, length, alignment)
    possible = np.zeros(least.shape, bool)
    for slot in range(group["low"].shape[1]):
        floor = np.maximum(kept.floor[:, slot], group["low"][:, slot])
        possible |= (most >= floor[:, None]) & (least <= group["high"][:, slot][:, None])
    possible &= (group["label"][:, None] != label) & (group["id"][:, None] != ids)
    q, c = np.nonzero(possible)
    scores = _scored(group["vector"], matrix, q, c)
    for slot in range(group["low"].shape[1]):
        floor = np.maximum(kept.floor[q, slot], group["low"][q, slot])
        good = (scores >= floor) & (scores <= group["high"][q, slot])
        kept.add(q[good], np.full(good.sum(), slot), ids[c[good]], scores[good])


def _search(index: DataFrame, anchors: DataFrame, load, chunk, k: int, width: int) -> DataFrame:
    """Every row against every file of anchors; the k best of each anchor and slot in each task."""
    files = anchors.inputFiles()  # a name for GROUP anchors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(width)
        # a few chunks are held, so that a file of anchors is read once for them
        held: list[pa.RecordBatch] = []

        def past() -> Iterator[pa.RecordBatch]:
            for file in files:
                group = load(pq.read_table(open_input(file)), turn)
                if group is None:
                    continue
                kept = Results(group["floor"], k)
                for batch in held:
                    chunk(group, kept, _rows(batch, width), turn)
                found = kept.rows(group["id"])
                if found is not None:
                    yield found

        for batch in _chunks(batches):
            held.append(batch)
            if len(held) * CHUNK * width >= 1 << 23:
                yield from past()
                held.clear()
        if held:
            yield from past()

    local = index.mapInArrow(run, SCORED)
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _grouped(df: DataFrame, rows: int, label: str) -> DataFrame:
    """``df``, of about ``rows`` rows, in files of ``GROUP`` rows at most."""
    path = scratch_path(df.sparkSession, label)
    dealt = df.repartition(max(1, -(-rows // GROUP)))
    dealt.write.option("maxRecordsPerFile", GROUP).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    least_percent: int = 50,
    most_percent: int = 95,
) -> DataFrame:
    """For each anchor and each of its ``positives`` best rows of its own label, the best negatives.

    ``vectors`` has ``vec_id``, ``label`` and ``vector`` (array of long); ``is_anchor`` is a condition
    on ``vec_id``. A negative has another label and a score between ``least_percent`` and
    ``most_percent`` of the positive's. Returns ``anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score``.
    """
    plain = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("vector").cast("array<long>").alias("vector"),
    ).where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    facts = plain.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(is_anchor).alias("anchors"), F.max(F.size("vector")).alias("width")
    ).first()
    width = max(1, facts.width or 1)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(width)
        for batch in _chunks(batches):
            code, length, alignment = encode(_matrix(batch.column("vector"), width), turn)
            columns = [*batch.columns, pa.array(list(code.view(np.int64)), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(length), pa.array(alignment)],
                ["vec_id", "label", "vector", "code", "length", "alignment"],
            )

    index = table(plain.mapInArrow(coded, INDEX), "codes")
    one = index.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("own"))
    one = one.select(F.col("vec_id").alias("anchor_id"), "own.label", "own.vector")
    anchors = _grouped(one, facts.anchors, "anchors")

    draw = F.pmod(F.xxhash64("vec_id", F.lit("bounds")), F.lit(1 << 30))
    share = min(1.0, SAMPLE / max(1, facts.n))
    drawn = index.where(draw < int(share * (1 << 30)) + 1).limit(2 * SAMPLE).toArrow()
    sample_ids, sample_labels, _, _, _, sample = _rows(drawn, width)

    def group_of(read: pa.Table, turn: np.ndarray) -> dict:
        matrix = _matrix(read["vector"], width)
        return {
            "id": read["anchor_id"].to_numpy(),
            "label": read["label"].to_numpy(),
            "vector": matrix,
            "coded": Anchors(matrix, turn),
        }

    def with_positive_floor(read: pa.Table, turn: np.ndarray) -> dict | None:
        if not len(read):
            return None
        group = group_of(read, turn)
        kept = Results(np.full((len(read), 1), LEAST), positives)
        same = (group["label"][:, None] == sample_labels) & (group["id"][:, None] != sample_ids)
        q, c = np.nonzero(same)
        kept.add(q, np.zeros(len(q), np.int64), sample_ids[c], _scored(group["vector"], sample, q, c))
        if kept.parts:
            kept._settle()
        return group | {"floor": kept.floor}

    first = _search(index, anchors, with_positive_floor, _positive_chunk, positives, width)
    hit = F.struct("rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    # at most ``positives`` entries for an anchor
    chosen = first.groupBy("anchor_id").agg(F.sort_array(F.collect_list(hit)).alias("positives"))
    paired = _grouped(anchors.join(chosen, "anchor_id"), facts.anchors, "pairs")

    def with_bands(read: pa.Table, turn: np.ndarray) -> dict | None:
        if not len(read):
            return None
        group = group_of(read, turn)
        low = np.full((len(read), positives), 2**63 - 1)
        high = np.full((len(read), positives), LEAST)
        for k, entries in enumerate(read["positives"].to_pylist()):
            for slot, entry in enumerate(entries):
                score = entry["positive_score"]
                # as 100 * negative lies between the two, by exact integers
                low[k, slot] = -(-least_percent * score // 100)
                high[k, slot] = most_percent * score // 100
        group |= {"low": low, "high": high}
        kept = Results(np.full(low.shape, LEAST), negatives)
        other = (group["label"][:, None] != sample_labels) & (group["id"][:, None] != sample_ids)
        q, c = np.nonzero(other)
        scores = _scored(group["vector"], sample, q, c)
        for slot in range(positives):
            good = (scores >= low[q, slot]) & (scores <= high[q, slot])
            kept.add(q[good], np.full(good.sum(), slot), sample_ids[c[good]], scores[good])
        if kept.parts:
            kept._settle()
        return group | {"floor": kept.floor}

    second = _search(index, paired, with_bands, _negative_chunk, negatives, width)
    slots = paired.select("anchor_id", F.posexplode("positives").alias("slot", "hit"))
    return second.join(slots, ["anchor_id", "slot"]).select(
        "anchor_id",
        F.col("hit.positive_id").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        F.col("hit.positive_score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
