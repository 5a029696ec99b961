"""SentencePiece ids, spans and texts against the library's."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from recordloom.llm import pieces, queries
from recordloom.llm import text as slices_of_text
from recordloom.llm.text import buffers

sentencepiece = pytest.importorskip("sentencepiece")

PARTS = [
    "a", "b", "the", "ing", " ", "  ", "\n", "é", "日", "👍", "▁", "\t", "0", "12", "<0x0A>", "�", "é",
    "ﬁ", "Å", "​", "　", "①", " ̈", "x" * 40, "\0", "\x85", "각",
]
AWKWARD = ["", " ", "   ", "\n", "▁", " a", "a ", "hello  world\n x  ", "x" * 5000, "<s> </s> <0x41>", "日本語" * 50]


@pytest.fixture(scope="module")
def data():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


def drawn(seed, n):
    choose = random.Random(seed)
    return ["".join(choose.choice(PARTS) for _ in range(choose.randint(0, 40))) for _ in range(n)]


def check(data, texts):
    """Ids, spans and decoded texts of all texts, worked on together."""
    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    model = pieces.Model(data)
    found = list(model.encode(*buffers(pa.array([t.encode() for t in texts], pa.binary()))))
    assert len(found) == len(texts)
    offsets = np.cumsum([0, *(len(ids) for ids, *_ in found)])
    decoded = model.decode(np.concatenate([ids for ids, *_ in found]), offsets)
    for text, (ids, begins, ends), shown in zip(texts, found, decoded):
        assert ids.tolist() == library.encode(text, add_bos=True, add_eos=True), text[:100]
        spans = [(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]
        assert list(zip(begins.tolist(), ends.tolist()))[1:-1] == spans, text[:100]
        size = len(text.encode())
        assert (begins[0], ends[0], begins[-1], ends[-1]) == (0, 0, size, size)
        assert shown.decode() == library.decode(ids.tolist()), text[:100]


def test_against_the_library(data):
    check(data, AWKWARD + drawn(1, 1500))


def other_model(data, rule, dummy_prefix, remove_extra, fallback):
    """The same pieces with another normaliser, and with or without bytes for unknown characters."""
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    spec = sentencepiece.SentencePieceNormalizer(
        rule_name=rule, add_dummy_prefix=dummy_prefix, escape_whitespaces=True, remove_extra_whitespaces=remove_extra
    )
    normalizer, model = proto.ModelProto(), proto.ModelProto()
    normalizer.ParseFromString(spec.serialized_model_proto())
    model.ParseFromString(data)
    model.normalizer_spec.CopyFrom(normalizer.normalizer_spec)
    if not fallback:
        model.trainer_spec.byte_fallback = False
        for piece in model.pieces:
            if piece.type == pieces.BYTE:
                piece.type = pieces.NORMAL
    return model.SerializeToString()


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nmt_nfkc_cf"])
@pytest.mark.parametrize("dummy_prefix", [True, False])
@pytest.mark.parametrize("remove_extra", [True, False])
@pytest.mark.parametrize("fallback", [True, False])
def test_compiled_character_maps(data, rule, dummy_prefix, remove_extra, fallback):
    other = other_model(data, rule, dummy_prefix, remove_extra, fallback)
    assert pieces.Model(other).normalizer.map is not None
    check(other, AWKWARD + drawn(2, 300))


def test_long_texts_are_cut_without_a_trace(data, monkeypatch):
    monkeypatch.setattr(pieces, "PART", 64)
    texts = drawn(3, 200) + ["words and words 12 of text " * 40, "no cut" + "-" * 500, "ab " * 200 + "\n", "é à " * 90]
    check(data, texts)
    check(other_model(data, "nmt_nfkc", True, True, True), texts)
    model = pieces.Model(data)
    ends = buffers(pa.array([t.encode() for t in texts], pa.binary()))
    assert any(len(at) > 5 for _, _, at in model._parts(*ends))


def test_segments_with_one_hash_are_kept_apart(data, monkeypatch):
    monkeypatch.setattr(slices_of_text, "span_hashes", lambda norm, start, end: (end - start).astype(np.uint64))
    check(data, drawn(4, 200))


def test_kept_segments_give_way(data, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_SEGMENTS", 5)
    monkeypatch.setattr(pieces, "PART", 200)
    check(data, drawn(5, 300))


def test_ids_that_are_no_text(data):
    model, library = pieces.Model(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    lists = [[3 + 0xE2, 3 + 0x82, 28705], [0], [1, 1, 28705, 6312], [3 + 0xFF] * 3, [], [2], [3 + 0xED, 3 + 0xA0, 3 + 0x80]]
    offsets = np.cumsum([0, *map(len, lists)])
    shown = model.decode(np.array([i for ids in lists for i in ids], np.int64), offsets)
    assert [s.decode() for s in shown] == [library.decode(ids) for ids in lists]
    with pytest.raises(ValueError, match="outside"):
        model.decode(np.array([40_000]), np.array([0, 1]))


def test_query_on_awkward_documents(spark, docs, empty, rows, data, tmp_path):
    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.QUERIES["op12_pieces"](spark, str(tmp_path))

    def sha256(raw):
        return hashlib.sha256(raw).hexdigest()

    expected = []
    for doc_id, text, _ in rows:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        decoded = library.decode(ids).encode()
        expected.append((doc_id, len(ids), sha256(np.array(ids, "<u4").tobytes()), sha256(decoded)))
    got = [tuple(r) for r in found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert pieces.digests(empty, data).count() == 0


def test_encode_and_decode_as_tables(spark, docs, empty, rows, data):
    encoded = pieces.encode(docs, data)
    texts = {(r.doc_id, r.text) for r in pieces.decode(encoded, data).collect()}
    assert texts == {(i, t or "") for i, t, _ in rows}
    for row in encoded.where("doc_id = 12").collect():
        raw = next(t for i, t, _ in rows if i == 12).encode()
        assert b"".join(raw[a:b] for a, b in zip(row.begins, row.ends)) == raw
    assert encoded.where("doc_id < 0").count() == pieces.encode(empty, data).count() == 0
    shown = sentencepiece.SentencePieceProcessor(model_proto=data).decode([6312])
    nothing = spark.createDataFrame([(1, None), (2, [None, 6312])], "doc_id long, ids array<int>")
    assert sorted(tuple(r) for r in pieces.decode(nothing, data).collect()) == [(1, ""), (2, shown)]


def test_other_kinds_of_models_are_errors(data):
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    model = proto.ModelProto()
    model.ParseFromString(data)
    model.trainer_spec.model_type = 1
    with pytest.raises(ValueError, match="byte-pair"):
        pieces.Model(model.SerializeToString())
    model.trainer_spec.model_type = 2
    model.pieces[500].type = pieces.USER_DEFINED
    with pytest.raises(ValueError, match="user-defined"):
        pieces.Model(model.SerializeToString())
