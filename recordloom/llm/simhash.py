"""Near duplicates by SimHash: a self-join of binary tries under a Hamming error budget.

Fingerprints are joined, not documents, so a group of copies is one leaf. Two
fingerprints that differ in at most ``budget`` bits agree in one of ``budget + 1`` blocks
of bits; the tries are built once for each block, with that block leading, and a node
pair there must agree in it without any error. So the pairs of subtries below one value
of a block are independent work: they are dealt out by that value, and large ones by
pairs of parts. Inside, pairs of nodes go down together, add up their differing bits and
end when these exceed the budget.

The links found in a task leave it as a forest (each fingerprint with the least of its
connected set there), which keeps every connection and grows with the fingerprints,
not with the pairs. Components follow by rounds of joins, each written to the shared
folder.

Defined results: a text without words has fingerprint zero and is linked like any
other; a null text is such a text. Rows that repeat stay; a null ``doc_id`` keeps its
row and is never a component's id unless the whole component has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm.folders import join_hot, ship_package, table
from recordloom.llm.text import slices, utf8

#: Fingerprints of one block value that a task works on at once.
PART = 1 << 14
#: Pairs of single fingerprints compared at once.
PAIRS = 1 << 21


def fingerprint(text: bytes, shingle: int) -> int:
    """Bits set in over half of the XXH64 values of the word shingles."""
    words = text.lower().split()  # of bytes: A to Z, and the six white spaces
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(shingle, len(words))
    digest = xxhash.xxh64_digest
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    hashes = np.frombuffer(b"".join([digest(joined[a:b], 42) for a, b in spans]), np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        counts += np.unpackbits(hashes[at : at + (1 << 14)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """``doc_id``, its 64-bit ``fingerprint`` (as a signed long), and ``body``, a hash of its text."""
    ship_package(docs.sparkSession)
    text = F.col("text").cast("string")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(text).alias("text"), _body(text).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], np.uint64)
            columns = [batch.column("doc_id"), pa.array(found.view(np.int64)), batch.column("body")]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fingerprint", "body"])

    return plain.mapInArrow(run, "doc_id long, fingerprint long, body long")


def _body(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _blocks(budget: int) -> list[tuple[int, int]]:
    """(first bit from the top, width) of ``budget + 1`` blocks of 64 bits."""
    cuts = [64 * i // (budget + 1) for i in range(budget + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def trie_pairs(a: np.ndarray, b: np.ndarray, roots: list[np.ndarray], budget: int, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in ``a`` and ``b`` (sorted, unsigned) of the pairs within the budget.

    ``roots`` are four arrays: the ranges of ``a`` and of ``b`` to pair up, each range
    a node of the trie at ``depth``. A range with itself gives each pair once.
    """
    same = a is b
    stack = [(depth, *roots, np.zeros(len(roots[0]), np.int8))]
    while stack:
        depth, a_lo, a_hi, b_lo, b_hi, errors = stack.pop()
        sizes = (a_hi - a_lo) * (b_hi - b_lo)
        done = (sizes <= 16) | (depth == 64)
        if done.any():
            yield from _compare(a, b, a_lo[done], a_hi[done], b_lo[done], b_hi[done], budget, same)
        a_lo, a_hi, b_lo, b_hi, errors = (x[~done] for x in (a_lo, a_hi, b_lo, b_hi, errors))
        if not len(a_lo):
            continue
        if len(a_lo) > 1 << 18:  # node pairs in blocks, so that the front stays small
            for at in range(0, len(a_lo), 1 << 17):
                stack.append((depth, *(x[at : at + (1 << 17)] for x in (a_lo, a_hi, b_lo, b_hi, errors))))
            continue
        a_mid, b_mid = _middles(a, a_lo, a_hi, depth), _middles(b, b_lo, b_hi, depth)
        children = [(a_lo, a_mid, b_lo, b_mid, errors), (a_mid, a_hi, b_mid, b_hi, errors), (a_lo, a_mid, b_mid, b_hi, errors + 1)]
        crossed = np.ones(len(a_lo), bool) if not same else (a_lo != b_lo) | (a_hi != b_hi)
        children.append(tuple(x[crossed] for x in (a_mid, a_hi, b_lo, b_mid, errors + 1)))
        joined = [np.concatenate(x) for x in zip(*children)]
        live = (joined[0] < joined[1]) & (joined[2] < joined[3]) & (joined[4] <= budget)
        if live.any():
            stack.append((depth + 1, *(x[live] for x in joined)))


def _middles(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
    """Where, in ranges that agree in the first ``depth`` bits, the next bit becomes 1."""
    bit = np.uint64(1) << np.uint64(63 - depth)
    first = (values[lo] | (bit - np.uint64(1)) | bit) ^ (bit - np.uint64(1))  # the least value with the bit
    return np.clip(np.searchsorted(values, first), lo, hi)


def _compare(a, b, a_lo, a_hi, b_lo, b_hi, budget, same):
    """All pairs of small or deep ranges, in blocks."""
    width = b_hi - b_lo
    row = np.repeat(np.arange(len(a_lo)), a_hi - a_lo)
    start = np.cumsum(a_hi - a_lo) - (a_hi - a_lo)
    left = a_lo[row] + np.arange(len(row)) - start[row]
    ends = np.cumsum(width[row])
    at = 0
    while at < len(row):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, side="right")))
        some = row[at:to]
        i = np.repeat(left[at:to], width[some])
        within = np.arange(len(i)) - np.repeat(np.cumsum(width[some]) - width[some], width[some])
        j = np.repeat(b_lo[some], width[some]) + within
        near = np.bitwise_count(a[i] ^ b[j]) <= budget
        if same:
            near &= i < j
        yield i[near], j[near]
        at = to


def forest(left: np.ndarray, right: np.ndarray, count: int, label: np.ndarray) -> np.ndarray:
    """``label`` (each node's root so far, a smaller node) with the links' sets joined."""
    while len(left):
        label = _rooted(label)
        a, b = label[left], label[right]
        open_ = a != b
        if not open_.any():
            break
        left, right, a, b = left[open_], right[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
    return _rooted(label)


def _rooted(label: np.ndarray) -> np.ndarray:
    while True:
        up = label[label]
        if np.array_equal(up, label):
            return label
        label = up


def links(distinct: DataFrame, budget: int) -> DataFrame:
    """Links (``a`` > ``b``, signed) that connect fingerprints as all pairs within ``budget`` would.

    ``distinct`` has one row for each ``fingerprint``.
    """
    blocks = _blocks(budget)
    rotated = F.array(
        *(
            F.struct(
                F.lit(k).alias("block"),
                (F.shiftleft("fingerprint", first).bitwiseOR(F.shiftrightunsigned("fingerprint", (64 - first) % 64)) if first else F.col("fingerprint")).alias("turned"),
                F.shiftrightunsigned(F.shiftleft("fingerprint", first), 64 - width).alias("value"),
            )
            for k, (first, width) in enumerate(blocks)
        )
    )
    rows = distinct.select(F.explode(rotated).alias("r")).select("r.*")
    sizes = rows.groupBy("block", "value").agg(F.count(F.lit(1)).alias("n"))
    # values with many fingerprints are cut into parts, and every pair of parts is a work item
    large = sizes.where(F.col("n") > PART).select("block", "value", F.ceil(F.col("n") / PART).cast("int").alias("parts"))
    known = rows.join(large, ["block", "value"], "left")
    part = F.pmod(F.xxhash64("turned"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    cut = known.where("parts IS NOT NULL").select("block", "value", "turned", part.alias("part"), other.alias("other"))
    cut = cut.select("block", "value", "turned", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), (F.col("part") == F.least("part", "other")).alias("first"))
    small = known.where("parts IS NULL").select("block", "value", "turned", F.lit(0).alias("p"), F.lit(0).alias("q"), F.lit(True).alias("first"))
    items = small.unionByName(cut).withColumn("item", F.xxhash64("block", "value", "p", "q"))
    dealt = items.repartition("item").sortWithinPartitions("block", "value", "p", "q")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        held = 0
        for batch in batches:
            waiting.append(batch)
            held += batch.num_rows
            if held >= 4 * PART:
                rows = pa.Table.from_batches(waiting)
                key = np.stack([rows[c].to_numpy() for c in ("block", "value", "p", "q")])
                changes = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0))
                if len(changes):
                    to = int(changes[-1]) + 1
                    yield from _item_links(rows.slice(0, to), blocks, budget)
                    rest = rows.slice(to).combine_chunks().to_batches()
                    waiting, held = rest, sum(b.num_rows for b in rest)
        if waiting:
            yield from _item_links(pa.Table.from_batches(waiting), blocks, budget)

    return dealt.select("block", "value", "turned", "p", "q", "first").mapInArrow(run, "a long, b long")


def _item_links(rows: pa.Table, blocks, budget: int) -> Iterator[pa.RecordBatch]:
    """The forests of whole work items; rows are sorted by item."""
    columns = {c: rows[c].to_numpy() for c in ("block", "value", "p", "q", "first")}
    turned = rows["turned"].to_numpy().view(np.uint64)
    key = np.stack([columns[c] for c in ("block", "value", "p", "q")])
    starts = np.concatenate([[0], np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1, [len(turned)]])
    crossing = columns["p"][starts[:-1]] != columns["q"][starts[:-1]]
    for block, (first, width) in enumerate(blocks):
        of = columns["block"][starts[:-1]] == block
        plain = np.flatnonzero(of & ~crossing)
        heads = columns["value"][starts[plain]]
        _, at, often = np.unique(heads, return_inverse=True, return_counts=True)
        alone = plain[often[at] == 1] if len(plain) else plain
        if len(alone):  # values that are no parts: one trie, entered at the node of each value
            values = np.unique(np.concatenate([turned[starts[i] : starts[i + 1]] for i in alone]))
            top = values >> np.uint64(64 - width)
            lo = np.flatnonzero(np.concatenate([[True], top[1:] != top[:-1]]))
            hi = np.append(lo[1:], len(values))
            yield from _forest_rows(values, values, [lo, hi, lo, hi], budget, first, width)
        for i in np.setdiff1d(plain, alone):
            own = np.unique(turned[starts[i] : starts[i + 1]])
            ends = [np.array([0]), np.array([len(own)])] * 2
            yield from _forest_rows(own, own, ends, budget, first, width)
        for i in np.flatnonzero(of & crossing):
            side = columns["first"][starts[i] : starts[i + 1]].astype(bool)
            own = turned[starts[i] : starts[i + 1]]
            a, b = np.unique(own[side]), np.unique(own[~side])
            if len(a) and len(b):
                ends = [np.array([0]), np.array([len(a)]), np.array([0]), np.array([len(b)])]
                yield from _forest_rows(a, b, ends, budget, first, width)


def _forest_rows(a, b, roots, budget, first, width):
    shift = 0 if a is b else len(a)
    both = a if a is b else np.concatenate([a, b])
    label = np.arange(len(both))
    for i, j in trie_pairs(a, b, roots, budget, width):
        if len(i):
            label = forest(i, j + shift, len(both), label)
    linked = np.flatnonzero(label != np.arange(len(both)))
    if len(linked):
        back = lambda x: ((x >> np.uint64(first)) | (x << np.uint64(64 - first)) if first else x).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(back(both[linked])), pa.array(back(both[label[linked]]))], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """``node`` and the least node of its connected set as ``root``, for edges (``a``, ``b``).

    Rounds of hooking and jumping: every root takes the least label around its set, then
    labels are followed once. The rounds grow with the logarithm of the longest chain;
    each is written to the shared folder, and one count comes back to the driver.
    """
    both = table(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = table(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "labels")
    count = labels.count()
    while True:
        of_a = labels.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
        of_b = labels.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
        ends = both.join(of_a, "a").join(of_b, "b").where("root_b < root_a")
        hooks = ends.groupBy(F.col("root_a").alias("root")).agg(F.min("root_b").alias("lower"))
        hooked = join_hot(labels, hooks, "root", count, "left")
        hooked = hooked.select("node", F.coalesce("lower", "root").alias("root"), F.col("lower").isNotNull().alias("moved"))
        hooked = table(hooked, "hooked")
        up = hooked.select(F.col("node").alias("root"), F.col("root").alias("above"))
        jumped = join_hot(hooked, up, "root", count, "left")
        jumped = jumped.select("node", F.coalesce("above", "root").alias("root"), (F.col("moved") | (F.col("above") < F.col("root"))).alias("moved"))
        jumped = table(jumped, "labels")
        labels = jumped.select("node", "root")
        if not jumped.where("moved").limit(1).count():
            return labels


def _grouped(docs: DataFrame, shingle: int, budget: int) -> DataFrame:
    """``doc_id, fingerprint, body`` with ``component_id`` and ``root``, the component's least fingerprint."""
    prints = table(fingerprints(docs, shingle), "fingerprints")
    # least(...) of a group that holds null ids only stays null
    distinct = table(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(table(links(distinct, budget), "links"))
    rooted = distinct.join(roots, distinct["fingerprint"] == roots["node"], "left")
    rooted = table(rooted.select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = join_hot(rooted, table(least, "least"), "root", rooted.count())
    return join_hot(prints, table(ids.select("fingerprint", "component_id", "root"), "ids"), "fingerprint", prints.count())


def near_duplicates(docs: DataFrame, shingle: int, budget: int) -> DataFrame:
    """``doc_id``, ``fingerprint`` (long) and ``component_id``, the least ``doc_id`` reachable by links."""
    return _grouped(docs, shingle, budget).select("doc_id", "fingerprint", "component_id")


def first_of_each(docs: DataFrame, shingle: int, budget: int) -> DataFrame:
    """One document of each component, with its columns: the one with the least ``doc_id``.

    Rows that repeat this id stay as they are, if they are in this component. Of a component without
    any id one row stays, the one with the least fingerprint (ties by a hash of the text).
    """
    found = _grouped(docs, shingle, budget)
    own = F.col("doc_id").eqNullSafe(F.col("component_id"))
    named = found.where(own & F.col("doc_id").isNotNull()).select("doc_id", "body").distinct()
    nameless = found.where("component_id IS NULL").groupBy("root").agg(F.min(F.struct("fingerprint", "body")).alias("first"))
    kept = named.unionByName(nameless.select(F.lit(None).cast("long").alias("doc_id"), F.col("first.body").alias("body")))
    kept = kept.select(F.col("doc_id").alias("_id"), F.col("body").alias("_body"))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    rows = docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("id"), _body(F.col("text").cast("string")).alias("body"))
    left = rows.join(kept, rows["id"].eqNullSafe(kept["_id"]) & (rows["body"] == kept["_body"]), "left_semi")
    one = left.where("id IS NULL").dropDuplicates(["body"])
    return left.where("id IS NOT NULL").unionByName(one).select("row.*")
