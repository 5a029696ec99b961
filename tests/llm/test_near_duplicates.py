"""SimHash, substrings and line templates against plain versions."""

import hashlib
import random

import numpy as np
import pytest
from plain import components, fingerprint, line_templates, removed_words
from pyspark.sql import functions as F

from recordloom.llm import line_templates as templates
from recordloom.llm import folders, simhash, substring


def close(a, b):
    return (a ^ b).bit_count() <= 4


def test_fingerprints(docs, rows):
    found = {(r["doc_id"], r["fingerprint"] % 2**64) for r in simhash.fingerprints(docs, 4).collect()}
    assert found == {(i, fingerprint(t)) for i, t, _ in rows}


def test_documents_of_each_component(docs, rows, empty):
    ids = [i for i, _, _ in rows]
    prints = [fingerprint(t) for _, t, _ in rows]
    first = components(prints, close)
    least = {f: min((i for i, g in zip(ids, first) if g == f and i is not None), default=None) for f in first}
    expected = sorted(((i, p, least[f]) for i, p, f in zip(ids, prints, first)), key=str)
    found = simhash.near_duplicates(docs, 4, 4).collect()
    assert sorted(((r["doc_id"], r["fingerprint"] % 2**64, r["component_id"]) for r in found), key=str) == expected
    kept = simhash.first_of_each(docs, 4, 4)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect() if r["doc_id"] is not None} == {x for x in least.values() if x is not None}
    assert simhash.near_duplicates(empty, 4, 4).count() == simhash.first_of_each(empty, 4, 4).count() == 0


def clouds(seed, count):
    """Fingerprints around a few centres, with chains, and some on their own."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(4)]
    out = {0, 2**64 - 1, 1 << 63}
    for _ in range(count):
        value = rng.choice(centres)
        for _ in range(rng.randrange(7)):
            value ^= 1 << rng.randrange(64)
        out.add(value if rng.random() < 0.8 else rng.getrandbits(64))
    return sorted(out)


@pytest.mark.parametrize("part", [1 << 14, 16])
def test_links_lose_no_connection(spark, monkeypatch, part):
    monkeypatch.setattr(simhash, "PART", part)
    values = clouds(part, 260)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    distinct = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    links = simhash.links(distinct, 4).collect()
    place = {v: k for k, v in enumerate(values)}
    pairs = [(place[r["a"] % 2**64], place[r["b"] % 2**64]) for r in links]
    near = set(pairs) | {(b, a) for a, b in pairs}
    expected = components(values, close)
    assert components(range(len(values)), lambda a, b: (a, b) in near) == expected
    roots = {r["node"] % 2**64: r["root"] for r in simhash.components(spark.createDataFrame(links, "a long, b long")).collect()}
    for k, v in enumerate(values):
        group = [signed[j] for j in range(len(values)) if expected[j] == expected[k]]
        assert roots.get(v, min(group)) == min(group)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(1000, 1001), (7, 7)], "a long, b long")
    roots = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert roots == {**{k: 0 for k in range(201)}, 1000: 1000, 1001: 1000}


def test_rows_without_an_id_stay_once(spark):
    """A copy without an id goes, an unlike row without one stays, copies of it do not."""
    near = " ".join(f"w{i}" for i in range(300))
    other = " ".join(f"x{i}" for i in range(300))
    rows = [(1, near), (None, near), (None, near + " w300"), (None, other), (None, other), (2, "short"), (2, "unlike words here"), (3, "short")]
    kept = simhash.first_of_each(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 4, 4)
    found = sorted((tuple(r) for r in kept.collect()), key=str)
    assert found == sorted([(1, near), (None, other), (2, "short"), (2, "unlike words here")], key=str)


def test_hot_keys_are_joined_apart(spark, monkeypatch):
    monkeypatch.setattr(folders, "HOT_ROWS", 5)
    rows = spark.createDataFrame([(7, k) for k in range(50)] + [(k, k) for k in range(20)] + [(99, 1)], "key long, n long")
    table = spark.createDataFrame([(k, -k) for k in range(20)], "key long, value long")
    for how in ("inner", "left"):
        found = folders.join_hot(rows, table, "key", 71, how)
        assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, rows.join(table, "key", how).collect()), key=str)
    edges = spark.createDataFrame([(0, k) for k in range(1, 200)] + [(500, 501)], "a long, b long")
    roots = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert roots == {**{k: 0 for k in range(200)}, 500: 500, 501: 500}


def test_windows_of_one_hash_are_told_apart_by_words(spark, monkeypatch):
    rows = [(k, f"a b c {'d' if k % 2 else 'e'} f g {'h' * (k % 3)}") for k in range(9)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    stored, _, _ = substring._sliced(frame, 4, "doc_id")
    payload = stored.first()["rows"]
    right = substring.Slice(payload, 4)
    monkeypatch.setattr(substring, "ngrams", lambda hashes, n: np.zeros(max(0, len(hashes) - n + 1), np.uint64))
    found = substring.Slice(payload, 4)
    assert len(found.keys) == len(right.keys) > 3 and len(set(found.keys.tolist())) == 1
    assert [found.least[k] for k in found.of] == [right.least[k] for k in right.of]
    assert [found.several[k] for k in found.of] == [right.several[k] for k in right.of]


def test_no_table_is_left_in_the_catalog(spark, docs):
    before = {t.name for t in spark.catalog.listTables()}
    assert substring.digests(docs, 13).count() == docs.count()
    assert {t.name for t in spark.catalog.listTables()} == before


def check_substrings(frame, pairs, window):
    words, gone = removed_words(pairs, window)
    expected = []
    for (i, _), w, g in zip(pairs, words, gone):
        kept = " ".join(x for k, x in enumerate(w) if k not in g)
        expected.append((i, len(w), len(g), hashlib.sha256(kept.encode()).hexdigest()))
    assert sorted(map(tuple, substring.digests(frame, window).collect()), key=str) == sorted(expected, key=str)


def test_substrings(docs, rows, empty):
    check_substrings(docs, [(i, t) for i, t, _ in rows], 13)
    assert substring.digests(empty, 13).count() == 0
    cut = substring.drop_repeats(docs, 13)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    texts = {r["doc_id"]: r["text"] for r in cut.collect() if r["doc_id"] is not None}
    assert texts[1] is None and texts[0] == rows[0][1] and texts[6] == rows[6][1]
    assert texts[13] == "other end" and texts[8].split() == ["tail"]
    assert substring.drop_repeats(empty, 13).count() == 0


def test_substrings_in_small_groups(spark, monkeypatch):
    """Many groups, parts, prefixes to split and slices; few words, so that prefixes are hot."""
    monkeypatch.setattr(substring, "GROUP", 40)
    monkeypatch.setattr(substring, "FREQUENT", 0.02)
    monkeypatch.setattr(substring, "FILTER_PART", 100)
    monkeypatch.setattr(substring, "FILTER_BITS", 8)
    rng = random.Random(4)
    vocabulary = ["a", "b", "ab", "é", "the"]
    shared = [" ".join(rng.choices(vocabulary, k=9)) for _ in range(6)]
    pairs = []
    for i in range(60):
        parts = [" ".join(rng.choices(vocabulary, k=rng.randrange(12))) for _ in range(3)]
        pairs.append((rng.randrange(1000) * 100 + i, "\n ".join([*parts, rng.choice(shared), rng.choice(shared)])))
    frame = spark.createDataFrame(pairs, "doc_id long, text string").repartition(4)
    check_substrings(frame, pairs, 4)


def test_prefixes_are_split_that_every_slice_has_once(spark, monkeypatch):
    monkeypatch.setattr(substring, "GROUP", 40)
    monkeypatch.setattr(substring, "SLICE_BYTES", 1)
    pairs = [(i, f"hot {'and' if i % 3 else 'or'} w{i % 50} x{i % 50}") for i in range(150)]
    frame = spark.createDataFrame(pairs, "doc_id long, text string").repartition(4)
    stored, windows, _ = substring._sliced(frame, 4, "doc_id")
    assert stored.count() == windows == len(pairs)
    split = substring._split_prefixes(substring._filter(stored, 4, windows)[1])
    for row in stored.select("rows").collect():
        found = substring.Slice(row["rows"], 4)
        hot = [substring._prefix(found.hashes, found.starts, level)[0] for level in (1, 2, 3)]
        assert substring._member(split, np.array(hot, np.uint64)).tolist() == [True, True, False]
    check_substrings(frame, pairs, 4)


TEMPLATE_DOCS = [
    (k, f"User {k} logged in from host h{k % 3}\nunique words of document number {'abcdefghijkl'[k]} only\n"
     + ("one two three four five six seven eight\n" if k % 2 else "one two three four five six seven nine\n")
     + ("one two three so different here it is\n" if k < 3 else "  \n"))
    for k in range(12)
] + [(50, None), (51, ""), (None, "User 9 logged in from host h1\nlast")]


def test_texts_are_shuffled_without_their_lines(spark):
    docs = spark.range(30).selectExpr("id as doc_id", "concat('the same line here\\nline ', id) as text")
    def shuffled(plan):
        """The columns of each exchange, without those of the plan's inputs."""
        own = [[plan.output().apply(k).name() for k in range(plan.output().size())]] if plan.nodeName() == "Exchange" else []
        inner = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else None
        below = [inner] if inner else [plan.children().apply(k) for k in range(plan.children().size())]
        return [*own, *(x for p in below for x in shuffled(p))]

    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = templates.drop_recurring(docs, 2, counts=True)
        columns = shuffled(found._jdf.queryExecution().executedPlan())
        assert found.agg(F.sum("n_lines"), F.sum("n_dropped")).first()[:] == (60, 58)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    assert [of for of in columns if "row" in of] == [["row", "document"]]


@pytest.mark.parametrize("min_documents", [2, 4, 12, 14])
def test_line_templates(spark, min_documents):
    frame = spark.createDataFrame(TEMPLATE_DOCS, "doc_id long, text string").repartition(3)
    found = templates.drop_recurring(frame, min_documents, counts=True).collect()
    expected = line_templates(TEMPLATE_DOCS, min_documents, templates.SIMILAR)
    assert {r["doc_id"]: r["text"] for r in found} == {i: t for (i, _), t in zip(TEMPLATE_DOCS, expected)}
    for r, text in ((r, dict(TEMPLATE_DOCS)[r["doc_id"]]) for r in found):
        lines = 0 if text is None else len(text.split("\n"))
        left = 0 if r["text"] is None else r["text"].count("\n") + 1
        assert r["n_lines"] == lines and r["n_dropped"] in (lines - left, lines - left + (r["text"] == ""))


@pytest.mark.parametrize("rows_to_broadcast", [0, 10**6])
def test_line_templates_of_awkward_documents(docs, rows, empty, monkeypatch, rows_to_broadcast):
    monkeypatch.setattr(templates, "BROADCAST_LEAVES", rows_to_broadcast)
    found = templates.drop_recurring(docs, 2)
    assert found.columns == docs.columns
    distinct = list(dict.fromkeys((i, t) for i, t, _ in rows))
    expected = dict(zip(distinct, line_templates(distinct, 2, templates.SIMILAR)))
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in found.collect()) == sorted(
        (str(i), expected[i, t] or "") for i, t, _ in rows
    )
    assert templates.drop_recurring(empty, 2).count() == 0


def test_line_templates_run_in_the_engine_alone(docs):
    plan = templates.drop_recurring(docs, 2)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_repeated_rows_share_their_outcome(spark):
    frame = spark.createDataFrame([(k // 2, "same line of text\nrest") for k in range(6)], "doc_id long, text string")
    found = templates.drop_recurring(frame, 3).groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("n")).collect()
    assert {tuple(r) for r in found} == {(0, "same line of text\nrest", 2), (1, "", 2), (2, "", 2)}
