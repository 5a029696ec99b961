"""Exact top-k by inner product: a Voronoi join.

Pivots are fitted on a bounded sample and only steer the work. Every vector goes to the
cell of its nearest pivot. For a query q and a member x of a cell with pivot p,
``q.x <= q.p + |q| |x - p|``; and q's k-th best score among sampled vectors bounds its
k-th best of all from below. So each query has, for each cell, the least distance from
the pivot at which a member can still matter. Queries of neighbouring cells form a
group; the least of its queries' distances decides which members are sent to it. A group
then solves exactly, its members in blocks, and the blocks' results are merged.

Groups and blocks have bounded size, also when a third of all vectors are one vector: a
cell's queries are cut into several groups, and members are dealt by a hash of their id.

Defined results: vectors that are null, or hold a null, NaN or infinity, and rows with a
null id take no part. Vectors are multiplied over their common length. Rows that repeat
are candidates each; a query id that repeats is one query (its least vector). Rows with
the query's id are no candidates.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm.folders import table

#: Sampled vectors for pivots and lower bounds; pivots at least and at most, the square root of the rows between.
SAMPLE, PIVOTS = 2048, (64, 512)
#: Queries of a group, and members that a group takes at once.
GROUP, BLOCK = 2048, 32_768


def quantized(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, or null for a vector that takes no part."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(good, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of equal width, zeros where a vector is shorter, without what is beyond the width."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and sizes.max() > width:
        within = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        values = values[within < width]
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products, exact (modulo 2^64 for huge components)."""
    most = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0))
    if most * a.shape[1] < 2.0**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Centres of the sample's clusters: a few rounds of k-means from evenly taken rows."""
    if not len(sample):
        return np.zeros((1, sample.shape[1]))
    points = sample.astype(np.float64)
    centres = points[np.linspace(0, len(points) - 1, min(count, len(points))).astype(int)]
    for _ in range(5):
        nearest = _distances(points, centres).argmin(axis=1)
        used = np.unique(nearest)
        centres = np.array([points[nearest == k].mean(axis=0) for k in used])
    return centres


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the k highest, ties to the smaller id.

    Both frames have ``vec_id`` and ``vector`` (array of long, null to take no part).
    """
    plain = [F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<long>").alias("vector")]
    rows = vectors.select(*plain).where("vec_id IS NOT NULL AND vector IS NOT NULL")
    asked = queries.select(*plain).where("vec_id IS NOT NULL AND vector IS NOT NULL")
    asked = asked.groupBy("vec_id").agg(F.min("vector").alias("vector"))

    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    width = max(1, facts.width or 1)
    draw = F.pmod(F.xxhash64("vec_id", F.lit("pivots")), F.lit(1 << 30))
    share = min(1.0, SAMPLE / max(1, facts.n))
    drawn = rows.where(draw < int(share * (1 << 30)) + 1).limit(2 * SAMPLE).toArrow()
    sample, sample_ids = _matrix(drawn["vector"], width), drawn["vec_id"].to_numpy()
    order = np.lexsort((*sample.T, sample_ids))
    sample, sample_ids = sample[order], sample_ids[order]
    pivots = _pivots(sample, min(PIVOTS[1], max(PIVOTS[0], math.isqrt(facts.n) // 4)))

    def placed(batches):
        for batch in batches:
            matrix = _matrix(batch.column("vector"), width).astype(np.float64)
            distance = _distances(matrix, pivots)
            cell = distance.argmin(axis=1)
            columns = [*batch.columns, pa.array(cell, pa.int32()), pa.array(distance[np.arange(len(cell)), cell])]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "vector", "cell", "distance"])

    schema = "vec_id long, vector array<long>, cell int, distance double"
    members = table(rows.mapInArrow(placed, schema), "cells")
    summary = members.groupBy("cell").agg(F.max("distance").alias("radius")).collect()  # one row for each pivot
    radius = np.full(len(pivots), -1.0)
    for row in summary:
        radius[row.cell] = row.radius

    def bounded(batches):
        for batch in batches:
            matrix = _matrix(batch.column("vector"), width)
            ids = batch.column("vec_id").to_numpy()
            cell = _distances(matrix.astype(np.float64), pivots).argmin(axis=1)
            least = np.full(len(ids), -(2**63))
            if len(sample) > k:
                # one more than k, as one of them may be the query itself
                products = _products(matrix, sample)
                own = ids[:, None] == sample_ids[None]
                products[own] = -(2**63)
                least = -np.partition(-products.astype(np.float64), k - 1, axis=1)[:, k - 1]
                least = np.where(np.isfinite(least), least, -(2.0**63))
            length = np.sqrt((matrix.astype(np.float64) ** 2).sum(axis=1))
            centre = matrix.astype(np.float64) @ pivots.T
            slack = 1e-6 * (1 + np.abs(centre) + np.abs(least)[:, None] + length[:, None] * radius.clip(0))
            gap = least[:, None] - centre - slack
            need = np.where(gap <= 0, 0.0, gap / np.maximum(length, 1e-300)[:, None])
            need[:, radius < 0] = np.inf
            need[need > radius] = np.inf
            columns = [*batch.columns, pa.array(cell, pa.int32()), pa.array(least.astype(np.float64)), pa.array(list(need))]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "vector", "cell", "least", "need"])

    schema = "vec_id long, vector array<long>, cell int, least double, need array<double>"
    bounds = table(asked.mapInArrow(bounded, schema), "bounds")
    # groups: cells in order, filled up to GROUP queries, large cells cut by a hash of the id
    parts, first, room = [], 0, 0
    for row in sorted(bounds.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: r.cell):
        if row.n > room:
            first, room = first + 1, GROUP
        cut = -(-row.n // GROUP)
        parts.append((row.cell, first, cut))
        first, room = first + cut - 1, room - row.n if cut == 1 else 0
    of_cell = vectors.sparkSession.createDataFrame(parts, "cell int, first int, parts int")
    group = F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
    grouped = bounds.join(F.broadcast(of_cell), "cell")  # a row for each pivot
    grouped = grouped.select("vec_id", "vector", "least", "need", group.alias("group"))
    needs = grouped.select("group", F.posexplode("need").alias("cell", "need")).groupBy("group", "cell").agg(F.min("need").alias("need"))
    needs = table(needs.where(F.col("need") < float("inf")), "needs")

    blocks = max(1, -(-facts.n // BLOCK))
    block = F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks)).cast("int")
    sent = members.join(needs, "cell").where(F.col("distance") >= F.col("need"))
    sent = sent.select("group", block.alias("block"), "vec_id", "vector")
    # a group's queries go to the blocks in which it has members, which numbers alone tell
    there = table(sent.select("group", "block").distinct(), "pairs")
    wanted = grouped.join(there, "group").select("group", "block", "vec_id", "vector", "least")

    def solve(wanted: pa.Table, sent: pa.Table) -> pa.Table:
        found = []
        if len(wanted) and len(sent):
            ids, candidates = wanted["vec_id"].to_numpy(), sent["vec_id"].to_numpy()
            asked, least = _matrix(wanted["vector"], width), wanted["least"].to_numpy().copy()
            for at in range(0, len(sent), 2048):
                part = slice(at, at + 2048)
                scores = _products(asked, _matrix(sent["vector"][part], width))
                q, c = np.nonzero((scores >= least[:, None]) & (ids[:, None] != candidates[None, part]))
                found.append((q, candidates[part][c], scores[q, c]))
                if sum(len(x[0]) for x in found) > 4 * k * len(ids):
                    found = [_best(*(np.concatenate(x) for x in zip(*found)), k)]
                    q, _, score = found[0]
                    full = np.bincount(q, minlength=len(ids)) >= k
                    worst = np.full(len(ids), np.inf)
                    np.minimum.at(worst, q, score.astype(np.float64))
                    least = np.where(full, np.maximum(least, worst), least)
            q, c, score = _best(*(np.concatenate(x) for x in zip(*found)), k)
            return pa.table({"query_id": ids[q], "vec_id": c, "score": score.astype(np.int64)})
        return pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "vec_id", "score")})

    pairs = wanted.groupBy("group", "block").cogroup(sent.groupBy("group", "block"))
    local = pairs.applyInArrow(solve, "query_id long, vec_id long, score long")
    # every block gives at most k rows of a query; these are merged as they are sorted, k at a time
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _best(q: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int):
    """The k best of each query, ties to the smaller id."""
    order = np.lexsort((ids, -scores, q))
    q, ids, scores = q[order], ids[order], scores[order]
    starts = np.searchsorted(q, q, side="left")
    kept = np.arange(len(q)) - starts < k
    return q[kept], ids[kept], scores[kept]
