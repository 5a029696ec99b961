"""Encoding, storing and packing against the libraries themselves."""

import base64
import hashlib
import random
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recordloom.llm import bpe, encoder, packing, queries, token_store

FILE = queries.vocabulary("byte_bpe_50k.json")
RANKS = queries.vocabulary("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_str(FILE)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in RANKS.splitlines())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def odd_texts():
    rng = random.Random(1)
    parts = ["a", "the", "é", " ", "  ", "\n", "\n\n", "\t", "'s", "'", "12", "²", "_", ".", "!?", " ", "日", "👍", "\r\n", "\x1c"]
    return ["".join(rng.choices(parts, k=rng.randrange(1, 14))) for _ in range(800)]


def test_pieces_encode_as_whole_texts(library, reference, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_PIECES", 200)
    own, codec = encoder.Encoder(FILE), bpe.Codec(RANKS, PATTERN)
    own.limit = 200
    texts = odd_texts()
    for at in range(0, len(texts), 50):
        batch = texts[at : at + 50]
        assert [x.tolist() for x in own.encode(batch)] == [library(t) for t in batch]
        ids = [x.tolist() for x in codec.encode(batch)]
        assert ids == [reference(t) for t in batch]
        assert [codec.decode(x).decode() for x in ids] == batch


def test_long_and_short_matches_merge_alike(reference):
    codec = bpe.Codec(RANKS, PATTERN)
    rng = random.Random(2)
    for size in (1, 2, 3, 15, 16, 17, 63, 64, 65, 700):
        word = "".join(rng.choices("abcdehinorst", k=size))
        assert codec.encode([word])[0].tolist() == reference(word)
        leaves = 1 << (size - 1).bit_length()
        if size <= bpe.SHORT:
            assert codec.merge_many([word.encode()] * 2, leaves) == [codec.merge_one(word.encode())] * 2


def test_bpe_query_columns(spark, docs, rows, empty, reference):
    found = bpe.digests(docs, RANKS, PATTERN)
    expected = []
    for doc_id, text, _ in rows:
        ids = reference(text or "")
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        expected.append((doc_id, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    assert bpe.digests(empty, RANKS, PATTERN).count() == 0
    decoded = bpe.decode(bpe.encode(docs, RANKS, PATTERN), RANKS, PATTERN)
    texts = sorted((r["doc_id"], bytes(r["decoded"]).decode()) for r in decoded.where("doc_id IS NOT NULL").collect())
    assert texts == sorted((i, t or "") for i, t, _ in rows if i is not None)


@pytest.mark.parametrize("file_bytes", [1 << 30, 50_000])
def test_store_round_trip(spark, docs, rows, library, monkeypatch, file_bytes):
    monkeypatch.setattr(token_store, "FILE_BYTES", file_bytes)
    folder = token_store.write_store(docs, FILE, 2)
    found = token_store.read_store(spark, folder).orderBy("start").collect()
    assert [r["doc_id"] for r in found] == sorted((i for i, _, _ in rows), key=lambda i: (i is not None, i))
    before = 0
    ids = {i: [*library(t), 2] for i, t, _ in rows if i is not None}
    for row in found:
        assert row["start"] == before and row["n_tokens"] == len(row["ids"])
        if row["doc_id"] is not None:
            assert row["ids"] == ids[row["doc_id"]]
        before += row["n_tokens"]
    assert [x.tolist() for x in token_store.read_document(spark, folder, 11)] == [ids[11]] * 2
    assert token_store.read_document(spark, folder, 12345) == []
    if file_bytes < 1 << 20:
        assert spark.read.parquet(f"{folder}/files").count() > 1


def test_store_of_nothing_and_of_another_dictionary(spark, empty, docs):
    folder = token_store.write_store(empty, FILE, 2)
    assert token_store.read_store(spark, folder).count() == 0
    path = spark.read.parquet(token_store.write_store(docs, FILE) + "/files").first()["path"]
    with pytest.raises(ValueError, match="dictionary"):
        token_store.StoredFile(path, b"another")


def test_a_store_goes_through_the_texts_twice(spark, monkeypatch):
    """Once to measure and sample them, once to encode; not again for the sample."""
    monkeypatch.setattr(token_store, "DICTIONARY_DOCUMENTS", 40)
    gone_through = spark.sparkContext.accumulator(0)

    def text(k):
        gone_through.add(1)
        return f"text {k} of a few"

    of = F.udf(text, "string").asNondeterministic()
    folder = token_store.write_store(spark.range(50).select(F.col("id").alias("doc_id"), of("id").alias("text")), FILE, 2)
    assert token_store.read_store(spark, folder).count() == 50
    assert gone_through.value == 100


@pytest.mark.parametrize("doc_id", ["id", "1L", "cast(null as long)"])
def test_all_texts_are_measured_and_some_sampled(spark, monkeypatch, doc_id):
    monkeypatch.setattr(token_store, "DICTIONARY_DOCUMENTS", 40)
    docs = spark.sql(f"select {doc_id} as doc_id, if(id % 10 = 0, null, 'four') as text from range(0, 400, 1, 3)")
    size, texts = token_store.measured(docs, 400)
    assert size == 4 * 360 and len(texts) <= 40 and set(texts) <= {"four"}
    assert token_store.measured(docs.where("text = 'none'"), 0) == (0, [])


def test_new_pieces_are_kept_with_their_ids(library):
    of = encoder.Encoder(FILE)
    pieces = [f" new{k}x{k * k}".encode() for k in range(250)]
    found = of._looked_up([*pieces, pieces[0], b"\n"])
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [library(p.decode()) for p in [*pieces, pieces[0], b"\n"]]
    assert of._looked_up(pieces) == found[:250] and all(of.kept[p] == x for p, x in zip(pieces, found))


def test_kept_pieces_are_no_objects():
    """Rows of arrays: a dictionary had two objects for each piece, looked up one by one."""
    of = encoder.Encoder(FILE)
    of.encode(["to begin with"])
    before = sys.getallocatedblocks()
    for at in range(0, 40_000, 4000):
        of.encode([" ".join(f"new{k}x{k * k}" for k in range(at, at + 4000))])
    assert len(of.kept) > 40_000
    assert sys.getallocatedblocks() - before < 10_000


def test_pieces_that_share_a_hash_have_their_own_ids(library, monkeypatch):
    def few(data, start, end):
        return (data[start].astype(np.uint64) + (end - start).astype(np.uint64)) % np.uint64(7)

    monkeypatch.setattr(encoder, "span_hashes", few)
    own = encoder.Encoder(FILE)
    own.limit = 5
    texts = odd_texts()[:300]
    for at in range(0, len(texts), 30):
        batch = texts[at : at + 30]
        assert [x.tolist() for x in own.encode(batch)] == [library(t) for t in batch]
    assert len(own.kept) <= 7


def test_a_table_finds_what_was_added():
    table, rng = encoder.Table(), random.Random(3)
    words = list({"".join(rng.choices("abcdé ", k=rng.randrange(1, 9))).encode(): None for _ in range(20_000)})
    for at in range(0, len(words), 3000):
        some = words[at : at + 3000]
        some += some[:5]  # the same piece twice in what is added
        data, sizes = np.frombuffer(b"".join(some), np.uint8), np.array([len(w) for w in some])
        ends = np.cumsum(sizes)
        hashes = encoder.span_hashes(data, ends - sizes, ends)
        table.add(hashes, data, sizes, np.frombuffer(b"".join(zlib.crc32(w).to_bytes(4, "little") * len(w) for w in some), "<u4"), sizes)
    assert len(table) == len(words)
    assert all(table[w] == zlib.crc32(w).to_bytes(4, "little") * len(w) for w in words)
    with pytest.raises(KeyError):
        table[b"none of them"]


def test_few_documents_share_a_dictionary_too(spark):
    docs = spark.createDataFrame([(k, "the same words in every one of these few texts, again and again") for k in range(3)], "doc_id long, text string")
    folder = token_store.write_store(docs, FILE, 2)
    dictionary = bytes(spark.read.parquet(f"{folder}/dictionary").first()[0])
    assert len(dictionary) > 8
    rows = token_store.read_store(spark, folder).collect()
    assert len(rows) == 3 and len({tuple(r["ids"]) for r in rows}) == 1
    file = spark.read.parquet(f"{folder}/files").first()
    assert (file["least"], file["most"]) == (0, 2)


def best_fit(lengths, capacity):
    """Best-fit decreasing, piece by piece."""
    rests = []
    for length in sorted(lengths, reverse=True):
        fitting = [r for r in rests if r >= length]
        if fitting:
            rests.remove(min(fitting))
            rests.append(min(fitting) - length)
        else:
            rests.append(capacity - length)
    return len(rests)


def test_plan_uses_as_many_sequences_as_best_fit():
    rng = random.Random(3)
    for capacity in (10, 64, 100):
        for _ in range(20):
            lengths = [rng.randint(1, capacity) for _ in range(rng.randrange(1, 300))]
            counts = {k: lengths.count(k) for k in set(lengths)}
            runs = packing.plan(counts, capacity)
            fill, ranks = {}, {}
            for length, rank, pieces, first, offset in runs:
                assert ranks.get(length, 0) == rank
                ranks[length] = rank + pieces
                for k in range(first, first + pieces):
                    fill.setdefault(k, []).append((offset, length))
            assert ranks == counts and len(fill) == best_fit(lengths, capacity)
            for slots in fill.values():
                end = 0
                for offset, length in sorted(slots):
                    assert offset == end
                    end += length
                assert end <= capacity


@pytest.mark.parametrize("length", [1, 1023, 1024, 1025, 2048, 5000])
def test_only_the_first_piece_is_short(length):
    pieces = packing.cut_lengths(length, 1024)
    assert sum(n for _, n in pieces) == length and all(n == 1024 for _, n in pieces[1:])
    assert [s for s, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))]


def test_packed_documents(docs, rows, empty, library):
    found = packing.pack_documents(docs, FILE, 2, 1024, with_ids=True).collect()
    by_sequence = {}
    for row in found:
        assert row["length"] == len(row["ids"]) <= 1024
        assert row["ids_crc32"] == zlib.crc32(np.array(row["ids"], "<u4").tobytes())
        by_sequence.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for slots in by_sequence.values():
        end = 0
        for offset, length in sorted(slots):
            assert offset == end
            end += length
        assert end <= 1024
    lengths = [r["length"] for r in found]
    assert len(by_sequence) == best_fit(lengths, 1024)
    for doc_id, text, _ in rows:
        if doc_id not in (None, 11):
            own = sorted((r["start"], r["ids"]) for r in found if r["doc_id"] == doc_id)
            assert [x for _, ids in own for x in ids] == [*library(text), 2]
    assert packing.pack_documents(empty, FILE, 2, 1024).count() == 0


def test_packing_keeps_other_columns(spark):
    pieces = spark.range(50).select("id", (F.col("id") % 7).alias("length"), F.lit(1).alias("rank"), F.lit(2).alias("task"))
    packed = packing.pack(pieces, 7)
    assert packed.columns == ["id", "length", "rank", "task", "sequence_id", "offset"] and packed.count() == 50
