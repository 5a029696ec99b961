"""The stages, each on what its predecessor kept, against plain versions."""

import corpus_pipeline
import pytest
from plain import components, fingerprint, line_templates, removed_words
from pyspark.sql import functions as F

from recordloom.llm import line_templates as templates
from recordloom.llm import queries
from recordloom.llm.encoder import Encoder
from recordloom.llm.folders import table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(table(stage(spark, out[-1], SF_DIR), name))
    return out


def texts(frame):
    return {r["doc_id"]: r["text"] for r in frame.select("doc_id", "text").collect()}


def test_columns(steps):
    for frame in steps[:-1]:
        assert frame.columns == steps[0].columns
        assert frame.where("n_chars <> length(text)").count() == 0


def test_language_id_keeps_clean_documents(steps):
    assert texts(steps[1]) == texts(steps[0])


def test_line_dedup(steps):
    before = sorted(texts(steps[1]).items())
    expected = line_templates(before, templates.MIN_DOCUMENTS, templates.SIMILAR)
    assert texts(steps[2]) == {i: t for (i, _), t in zip(before, expected)}


def test_one_document_of_each_group_stays(steps):
    before = sorted(texts(steps[2]).items())
    prints = [fingerprint(t) for _, t in before]
    first = components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    assert set(texts(steps[3])) == {before[k][0] for k in first}


def test_substring_dedup(steps):
    before = sorted(texts(steps[3]).items())
    words, gone = removed_words(before, 13)
    for (i, text), w, g in zip(before, words, gone):
        expected = " ".join(x for k, x in enumerate(w) if k not in g) if g else text
        assert texts(steps[4])[i] == expected


def test_packing_and_run(spark, steps):
    before = texts(steps[4])
    encoder = Encoder.of(queries.vocabulary("byte_bpe_50k.json"))
    sizes = {i: len(encoder.encode([t])[0]) + 1 for i, t in before.items()}
    packed = steps[5].groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in packed} == sizes
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    whole = corpus_pipeline.run(spark, SF_DIR).select(*columns).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, steps[5].select(*columns).collect()))


def test_awkward_documents_pass_through(spark, docs, tmp_path, rows):
    folder = str(tmp_path / "sf")
    docs.write.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).count() > 0
    nothing = str(tmp_path / "none")
    docs.where("doc_id < 0").write.parquet(f"{nothing}/documents.parquet")
    assert corpus_pipeline.run(spark, nothing).count() == 0
