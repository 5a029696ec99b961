"""Language model, languages, repetition and search against plain versions."""

import collections
import glob
import math
import os
import random
import zlib

import duckdb
import numpy as np
import pytest
from plain import WORD, coverage, lowered, repetition
from pyspark.sql import functions as F

from recordloom.llm import knn, langid, ngram_lm, queries
from recordloom.llm import repetition as rules

SF_DIR = "/root/testdata/sf0.001"


def tokens_of(text):
    return [*WORD.findall(lowered(text)), None]


def discount(counts):
    n = [0] + [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
    if not (n[1] and n[2] and n[3]):
        return (0, 0.5, 1.0, 1.5)
    y = n[1] / (n[1] + 2 * n[2])
    found = (1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3])
    return (0, *found) if all(0 < d < k + 1 for k, d in enumerate(found)) else (0, 0.5, 1.0, 1.5)


class PlainModel:
    def __init__(self, texts, order):
        self.order, self.levels = order, {}
        grams = collections.Counter()
        for text in texts:
            tokens = ["<"] * (order - 1) + tokens_of(text)
            grams.update(tuple(tokens[k : k + order]) for k in range(len(tokens) - order + 1))
        for n in range(order, 0, -1):
            contexts = collections.defaultdict(list)
            for gram, count in grams.items():
                contexts[gram[:-1]].append(count)
            self.levels[n] = (grams, contexts, discount(list(grams.values())))
            grams = collections.Counter(gram[1:] for gram in grams)
        self.words = len(self.levels[1][0])

    def probability(self, gram):
        n = len(gram)
        if n == 0:
            return 1 / (self.words + 1)
        grams, contexts, d = self.levels[n]
        found = contexts.get(gram[:-1])
        if not found:
            return self.probability(gram[1:])
        count = grams.get(gram, 0)
        mass = sum(d[min(c, 3)] for c in found)
        return (count - d[min(count, 3)] + mass * self.probability(gram[1:])) / sum(found)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_language_model(docs, rows, monkeypatch, order):
    monkeypatch.setattr(ngram_lm, "SHARD_BYTES", 60_000)
    monkeypatch.setattr(ngram_lm, "HELD", 5_000)
    monkeypatch.setattr(ngram_lm, "LARGE", 20)
    known = [(i, t) for i, t, _ in rows if i is None or i % 3]
    model = ngram_lm.train(docs.where("doc_id IS NULL OR doc_id % 3 <> 0"), order)
    assert order == 1 or model.shards > 1
    plain = PlainModel([t for _, t in known], order)
    unigrams = collections.Counter(x for _, t in known for x in tokens_of(t))
    total, words = sum(unigrams.values()), len(unigrams)
    found = {(r["doc_id"], r["n_tokens"]): r for r in ngram_lm.score(docs, model).collect()}
    for i, text, _ in rows:
        tokens = tokens_of(text)
        row = found[i, len(tokens)]
        assert row["train_tokens"] == total and row["n_known"] == sum(x in unigrams for x in tokens)
        base = sum(math.log10((unigrams.get(x, 0) + 1) / (total + words + 1)) for x in tokens)
        assert math.isclose(row["base_score"], base, rel_tol=1e-9)
        padded = ["<"] * (order - 1) + tokens
        score = sum(math.log10(plain.probability(tuple(padded[k : k + order]))) for k in range(len(tokens)))
        assert math.isclose(row["score"], score, rel_tol=1e-9)


def test_language_model_of_nothing(docs, empty):
    model = ngram_lm.train(empty)
    assert model.tokens == 0
    assert all(r["score"] == 0 and r["base_score"] == 0 for r in ngram_lm.score(docs, model).collect())
    assert ngram_lm.score(empty, model).count() == 0


def test_language_model_beats_single_words_on_unseen_texts(spark):
    rows = queries.op1_ngram_lm(spark, SF_DIR).where("held_out").collect()
    assert rows and sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2 for r in rows)


def test_languages_of_unseen_texts(spark):
    rows = queries.op10_language_id(spark, "/root/testdata/sf0.01").where("held_out")
    truth = queries.documents(spark, "/root/testdata/sf0.01").select("doc_id", "lang")
    shares = rows.join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score"))
    right, least, most = shares.first()
    assert right > 0.98 and 0 <= least <= most <= 1


def test_languages_of_awkward_documents(spark, docs, empty, rows):
    known = queries.documents(spark, SF_DIR)
    model = langid.train(known, F.lit(True))
    found = {r["doc_id"]: r for r in langid.identify(docs, model).collect() if r["doc_id"] is not None}
    for i, text, _ in rows:
        if i is not None:
            letters = any(c.isalpha() for c in text or "")
            assert (found[i]["lang_pred"] == "und") != letters and (letters or found[i]["score"] == 0)
    assert {r["doc_id"] for r in langid.keep(docs, model).collect()}.isdisjoint({1, 2, 3, 14})
    assert langid.keep(docs, model).columns == docs.columns
    assert langid.identify(empty, model).count() == langid.keep(empty, model).count() == 0
    nothing = langid.train(known.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert {r["lang_pred"] for r in langid.identify(docs, nothing).collect()} == {"und"}
    one = langid.train(known.where("lang = 'de'"), F.lit(True))
    assert {r["lang_pred"] for r in langid.identify(known, one).collect()} == {"de"}


@pytest.mark.parametrize("languages", [2, 3, 6, 7, 40])
def test_codewords_are_apart(languages):
    code = langid.codewords(languages).astype(int)
    apart = [(code[a] != code[b]).sum() for a in range(languages) for b in range(a)]
    assert min(apart) >= max(1, code.shape[1] // 4)
    assert all(len(set(column)) == 2 for column in code.T)


def test_repetition(docs, rows, empty):
    found = rules.score(docs).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert sorted((str(r["doc_id"]), *(r[n] for n in names)) for r in found) == sorted(
        (str(i), *repetition(t)) for i, t, _ in rows
    )
    texts = {i: t for i, t, _ in rows if i is not None}
    for r in found:
        if r["doc_id"] is not None:
            for n in rules.COVERAGE:
                assert math.isclose(r[f"share_{n}"], coverage(texts[r["doc_id"]], n))
    kept = rules.keep(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in found)
    assert rules.score(empty).count() == rules.keep(empty).count() == 0


def test_repetition_of_random_texts(spark):
    rng = random.Random(6)
    pairs = [(k, "".join(rng.choices(["a ", "b ", "c\n", "dd ", "é\t", "#$ "], k=rng.randrange(60)))) for k in range(200)]
    found = {r["doc_id"]: r for r in rules.score(spark.createDataFrame(pairs, "doc_id long, text string")).collect()}
    for k, text in pairs:
        r = found[k]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == repetition(text)
        for n, most in rules.COVERAGE.items():
            assert math.isclose(r[f"share_{n}"], coverage(text, n))
            assert not r["kept"] or r[f"share_{n}"] <= most


def plain_top_k(vectors, asked, k):
    out = []
    for q, a in asked:
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in vectors if i != q)
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [(2048, 2048, 32_768), (30, 3, 40)])
def test_top_k(spark, monkeypatch, sizes):
    for name, size in zip(("SAMPLE", "GROUP", "BLOCK"), sizes):
        monkeypatch.setattr(knn, name, size)
    rng = np.random.default_rng(7)
    data = [(k, v.tolist()) for k, v in enumerate(rng.integers(-9, 10, (300, 6)))]
    data += [(k, [5, 5, 5, 0, 0, 0]) for k in range(300, 420)]  # one common vector, many ties
    data += [(500, [1, 2]), (501, [])]
    extra = [(None, [1, 2, 3, 4, 5, 6]), (502, None)]
    frame = spark.createDataFrame(data + extra, "vec_id long, vector array<long>").repartition(5)
    asked = [(i, v) for i, v in data if i % 10 == 0]
    found = knn.top_k(frame, frame.where("vec_id % 10 = 0"), 4).collect()
    assert sorted(map(tuple, found)) == plain_top_k(data, asked, 4)


def test_top_k_of_few_and_of_huge_values(spark):
    data = [(1, [2**31, -(2**31)]), (2, [2**30, 3]), (3, [-(2**31), 1])]
    frame = spark.createDataFrame(data, "vec_id long, vector array<long>")
    assert sorted(map(tuple, knn.top_k(frame, frame, 20).collect())) == plain_top_k(data, data, 20)
    assert knn.top_k(frame.where("vec_id > 9"), frame, 3).count() == 0
    assert knn.top_k(frame, frame.where("vec_id > 9"), 3).count() == 0


def test_vectors_that_take_no_part(spark):
    values = [[0.5, -0.01], None, [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], []]
    frame = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "vec_id long, embedding array<float>")
    found = frame.select("vec_id", knn.quantized(F.col("embedding"), 64).alias("v")).orderBy("vec_id").collect()
    assert [r["v"] for r in found] == [[32, -1], None, None, None, None, []]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_with_sql(spark, name):
    duck = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        duck.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS FROM '{path}'")
    result = queries.QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    expected = duck.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLES[name]})").fetchall()
    found = [tuple(r) for r in result.select(*columns).collect()]
    assert len(found) == len(expected)
    for a, b in zip(sorted(found, key=str), sorted(expected, key=str)):
        assert all(math.isclose(x, y) if isinstance(x, float) else x == y for x, y in zip(a, b)), (a, b)


def test_registered_language_model_has_order_three(spark):
    docs = [tuple(r) for r in queries.documents(spark, SF_DIR).select("doc_id", "text").collect()]
    held_out = {i: t for i, t in docs if i is not None and zlib.crc32(str(i).encode()) % 7 == 2}
    plain = PlainModel([t for i, t in docs if i not in held_out], 3)
    found = {r["doc_id"]: r["score"] for r in queries.op1_ngram_lm(spark, SF_DIR).where("held_out").collect()}
    for i in sorted(held_out, key=lambda i: len(held_out[i] or ""))[:5]:
        padded = ["<", "<", *tokens_of(held_out[i])]
        score = sum(math.log10(plain.probability(tuple(padded[k - 2 : k + 1]))) for k in range(2, len(padded)))
        assert math.isclose(found[i], score, rel_tol=1e-9)


@pytest.mark.parametrize("words", [0, 1, 2, 3, 9])
def test_packed_counts_come_back(words):
    rng = np.random.default_rng(words)
    listed = rng.integers(0, 2**64, 200, np.uint64)  # 9 places of 200 exceed 64 bits
    for rows in (1, 500):
        columns = [rng.choice(listed, rows) for _ in range(words)] or [np.sort(rng.integers(0, 2**64, rows, np.uint64))]
        parts = [*columns, rng.integers(1, 2**40, rows, np.uint64), np.ones(rows, np.uint64)]
        back = ngram_lm._unpack(ngram_lm._pack(parts, words), len(parts), words)
        assert sorted(zip(*map(np.ndarray.tolist, back))) == sorted(zip(*map(np.ndarray.tolist, parts)))


def test_languages_are_learned_from_long_texts(spark):
    long = {"en": "the quick brown fox and the lazy dog ", "de": "der schnelle braune Fuchs und der faule Hund "}
    rows = [(2 * i + k, "0 " * 15_000 + text * 800, lang) for i in range(6) for k, (lang, text) in enumerate(long.items())]
    rows += [(100 + i, text, None) for i, text in enumerate(long.values())]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(frame, F.lit(True))
    assert model.languages == ["de", "en"]
    found = {r["doc_id"]: r["lang_pred"] for r in langid.identify(frame, model).collect()}
    assert found[100] == "en" and found[101] == "de"
    taken = frame.select(F.octet_length(langid._sampled("text")).alias("n"), langid._sampled("text").alias("t")).where("doc_id < 100")
    assert all(r["n"] == langid.SAMPLE_LONGEST and b"0 0" in r["t"] and b"u" in r["t"] for r in taken.collect())


def test_texts_with_letters_stay_where_no_language_was_learned(docs, rows):
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    kept = langid.keep(unlabelled, langid.train(unlabelled, F.lit(True)))
    letters = [str(i) for i, t, _ in rows if any(c.isalpha() for c in t or "")]
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(letters)


@pytest.mark.parametrize("order", [2, 3, 7])
def test_language_model_with_frequent_words(docs, rows, monkeypatch, order):
    monkeypatch.setattr(ngram_lm, "SHARD_BYTES", 60_000)
    monkeypatch.setattr(ngram_lm, "HOT_BYTES", 600)  # words are frequent that occur 100 times
    model = ngram_lm.train(docs, order)
    # The contexts of such words lie in several shards; at order 7 they are hashed.
    assert model.shards > 1 and all(any(model.levels[n].sums) for n in range(2, order + 1))
    assert order < 7 or (order - 1) * model.numbers.bits > 64
    plain = PlainModel([t for _, t, _ in rows], order)
    found = {(r["doc_id"], r["n_tokens"]): r["score"] for r in ngram_lm.score(docs, model).collect()}
    for i, text, _ in rows:
        tokens = tokens_of(text)
        padded = ["<"] * (order - 1) + tokens
        score = sum(math.log10(plain.probability(tuple(padded[k : k + order]))) for k in range(len(tokens)))
        assert math.isclose(found[i, len(tokens)], score, rel_tol=1e-9)


def test_language_model_takes_little_disk(spark):
    random_ = random.Random(3)
    texts = [" ".join(f"word{int(random_.paretovariate(0.5)) % 30_000}" for _ in range(300)) for _ in range(1000)]

    def used():
        folder = spark.conf.get("spark.checkpoint.dir")
        return sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(folder) for f in files)

    before = used()
    ngram_lm.train(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 3)
    assert used() - before < 0.8 * sum(map(len, texts))


@pytest.mark.parametrize("width", [1, 2, 9, 17, 31, 40, 47, 58, 63, 64])
def test_sets_find_their_numbers(width):
    rng = np.random.default_rng(width)
    for size in (1, 6, 5000):
        listed = np.unique(rng.integers(0, 2**width, 2 * size, np.uint64))
        inside = rng.permutation(len(listed))[: max(1, len(listed) // 2)]
        arrays, order = ngram_lm._set(listed[inside], width)
        there, at = ngram_lm.Set(*arrays).find(listed)
        assert there.tolist() == sorted(inside.tolist())
        assert (listed[inside][order][at] == listed[there]).all()


@pytest.mark.parametrize("bits", [5, 21, 40])
def test_rows_are_counted(bits):
    rng = np.random.default_rng(bits)
    columns = [rng.choice(rng.integers(0, 2**bits, 9, np.uint64), 2000) for _ in range(3)]
    plain = collections.Counter(zip(*map(np.ndarray.tolist, columns)))
    for found, (counts,) in (ngram_lm.counted_rows(columns, bits), ngram_lm.added(columns, [np.ones(2000, np.uint64)], bits)):
        assert list(zip(zip(*map(np.ndarray.tolist, found)), counts.tolist())) == sorted(plain.items())
