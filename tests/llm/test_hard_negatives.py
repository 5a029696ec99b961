"""Hard negatives against a plain loop, and the intervals of the codes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordloom.llm import hard_negatives, knn
from recordloom.llm.hard_negatives import Anchors, encode, rotation

SCHEMA = "vec_id long, label int, embedding array<float>, code string, slot int, score int, anchor_id string"


def plain(rows, is_anchor, scale=256, positives=5, negatives=3, low=50, high=95):
    good = []
    for vec_id, label, vector, *_ in rows:
        if None in (vec_id, label, vector) or any(x is None or not np.isfinite(x) for x in vector):
            continue
        good.append((vec_id, label, [int(np.floor(float(np.float32(x)) * scale)) for x in vector]))
    width = max([len(v) for _, _, v in good], default=0)
    good = [(i, label, v + [0] * (width - len(v))) for i, label, v in good]
    out = []
    anchors = {}
    for i, label, v in good:
        if is_anchor(i):
            anchors[i] = min(anchors.get(i, (label, v)), (label, v))
    for i, (label, v) in anchors.items():
        scored = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in good if j != i]
        own = sorted((s, j) for s, j, other in scored if other == label)[:positives]
        for p, j in own:
            wrong = sorted((s, n) for s, n, other in scored if other != label and low * -p <= 100 * -s <= high * -p)
            out += [(i, j, rank, n, -p, -s) for rank, (s, n) in enumerate(wrong[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, every=3, partitions=3, **more):
    df = spark.createDataFrame([(*r, "c", 1, 2, "a") for r in rows], SCHEMA).repartition(partitions)
    vectors = df.select("*", knn.quantized(F.col("embedding"), 256).alias("vector"))
    found = hard_negatives.hard_negatives(vectors, F.col("vec_id") % every == 0, **more)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


def clustered(seed, n, width, labels=4):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(labels, width))
    label = draw.integers(0, labels, n)
    vectors = centres[draw.integers(0, labels, n)] * 0.4 + centres[label] * 0.5 + draw.normal(size=(n, width)) * 0.3
    return [(int(i), int(label[i]), [float(x) for x in vectors[i]]) for i in range(n)]


@pytest.mark.parametrize("width", [5, 64, 70])
def test_against_plain(spark, width):
    rows = clustered(width, 240, width)
    found = mined(spark, rows)
    assert found == plain(rows, lambda i: i % 3 == 0)
    assert found


def test_ties_repeats_and_rows_that_take_no_part(spark):
    rows = clustered(1, 60, 6, labels=2)
    rows += rows[:20] + [rows[3]] * 30  # repeated rows, also of anchors
    rows += [(100 + k, k % 3, [0.5, 0.5, 0.0, 0.0, 0.0, 0.0]) for k in range(40)]  # ties
    rows += [
        (None, 1, [0.1] * 6),
        (201, None, [0.1] * 6),
        (202, 1, None),
        (203, 1, [0.1, None, 0.1, 0.1, 0.1, 0.1]),
        (204, 1, [float("nan")] * 6),
        (205, 1, [float("inf")] * 6),
        (206, 1, []),
        (207, 0, [0.0] * 6),
        (9, 1, [0.3] * 6),
        (210, 1, [0.3] * 4),
    ]
    assert mined(spark, rows) == plain(rows, lambda i: i % 3 == 0)


def test_other_numbers_and_several_files_of_anchors(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "GROUP", 16)
    rows = clustered(7, 300, 8)
    found = mined(spark, rows, every=2, partitions=7, positives=2, negatives=4, least_percent=20, most_percent=60)
    assert found == plain(rows, lambda i: i % 2 == 0, positives=2, negatives=4, low=20, high=60)


def test_empty_tables_and_no_anchors(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [0.5]), (2, 2, [0.5])]) == []
    assert mined(spark, [(3, 1, [0.5])]) == []


@pytest.mark.parametrize("width", [1, 3, 64, 100])
def test_intervals_hold_and_most_pairs_are_settled_by_them(width):
    draw = np.random.default_rng(width)
    q = np.floor(draw.normal(size=(50, width)) * 256).astype(np.int64)
    x = np.floor(draw.normal(size=(400, width)) * 256).astype(np.int64)
    x[:20], q[0] = q[:20] * 2, 0
    turn = rotation(width)
    assert np.allclose(turn @ turn.T, np.eye(width))
    code, length, alignment = encode(x, turn)
    least, most = Anchors(q, turn).intervals(np.arange(50), code, length, alignment)
    exact = q @ x.T
    assert (least <= exact).all() and (exact <= most).all()
    # no wider than what Cauchy-Schwarz allows without codes
    bound = np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(x, axis=1)
    assert (most - least <= 2 * bound * 1.2 + 1).all()
    if width == 64:
        assert (most < bound * 0.9).mean() > 0.95


def test_rows_below_the_bounds_are_not_scored(spark):
    """The share of pairs that reach integer scoring on clustered vectors."""
    rows = clustered(3, 2000, 32)
    ids, labels = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    matrix = np.floor(np.array([r[2] for r in rows]) * 256).astype(np.int64)
    turn = rotation(32)
    own = np.flatnonzero(labels == 0)
    code, length, alignment = encode(matrix[own], turn)
    anchors = own[:40]
    _, most = Anchors(matrix[anchors], turn).intervals(np.arange(40), code, length, alignment)
    fifth = np.sort(matrix[anchors] @ matrix[own].T, axis=1)[:, -6]
    assert (most >= fifth[:, None]).mean() < 0.8
    assert len(ids) == 2000
