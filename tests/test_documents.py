"""Documents made from a table: small on disk, and the same however they are written."""

import bz2
import glob
import os
import random

import pyarrow.parquet as pq
import pytest

from recordloom.plans import catalogue, documents
from recordloom.plans.documents import COMPRESSION, write_documents, writing_session
from recordloom.sources.envelope import Export
from recordloom.sources.reading import reading_session
from recordloom.sources.scratch import scratch_path

COLUMNS = [{"fieldName": "x", "dataTypeName": "text"}]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("lines"))
    lines = spark.sql(
        "select id div 4 as l_orderkey, cast(id % 4 as int) as l_linenumber, hash(id) % 20000 as l_partkey, hash(id, 1) % 1000 as l_suppkey,"
        " double(id % 50) as l_quantity, (hash(id, 2) % 9000000) / 100D as l_extendedprice, substr('ANR', 1 + id % 3, 1) as l_returnflag,"
        " substr('FO', 1 + id % 2, 1) as l_linestatus, timestamp'1995-01-01' + make_dt_interval(id % 900) as l_shipdate from range(12000)"
    )
    lines.coalesce(2).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def files(path):
    return sorted(glob.glob(f"{path}/document=*/part-*"))


def text(path):
    """The documents' text by their number."""
    found = {}
    for file in files(path):
        with open(file, "rb") as stream:
            data = stream.read()
        found[file.split("document=")[1].split("/")[0]] = bz2.decompress(data) if file.endswith(".bz2") else data
    assert len(found) == len(files(path))
    return found


def test_registrations_take_a_fraction_of_their_text(spark, sf_dir):
    run = catalogue.registrations(spark, sf_dir)
    path = catalogue.registration_documents(spark, sf_dir)
    size = sum(os.path.getsize(file) for file in files(path))
    assert 0 < size < sum(map(len, text(path).values())) / 5
    staged = glob.glob(f"{run.staged.path}/*.parquet")
    assert {pq.ParquetFile(file).metadata.row_group(0).column(0).compression for file in staged} == {"ZSTD"}
    assert run.staged.table.count() == 12000


def test_rows_dealt_before_their_text_make_the_same_documents(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(documents, "DOCUMENT_LINES", 902)
    made = catalogue.registration_records
    lines = catalogue.table(writing_session(spark), sf_dir, "lineitem")
    plain = made(lines.selectExpr("*", "0 as document")).select("record", "n").selectExpr("*", "n div 10 as l_orderkey")
    write_documents(plain, COLUMNS, one := scratch_path(spark, "plain"), "l_orderkey", "n")
    monkeypatch.setattr(documents, "JOB_DOCUMENTS", 4)  # three jobs
    write_documents(lines, COLUMNS, many := scratch_path(spark, "dealt"), "l_orderkey", "n", made=made, compression=COMPRESSION)
    assert len(files(one)) == 14 and all(file.endswith(".bz2") for file in files(many))
    assert text(one) == text(many)


def test_shuffled_rows_go_when_the_documents_are_written(spark, sf_dir):
    def shuffled():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {blocks.apply(k).getName() for k in range(blocks.size())}

    before = shuffled()
    lines = catalogue.table(writing_session(spark), sf_dir, "lineitem")
    write_documents(lines, COLUMNS, scratch_path(spark, "gone"), "l_orderkey", "n", made=catalogue.registration_records)
    assert not {name for name in shuffled() - before if name.startswith("shuffle_")}


def test_a_compressed_document_is_read_by_many_tasks(spark):
    chosen = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    records = [("[\"" + "".join(chosen.choices(letters, k=chosen.randrange(6))) + "\"]",) for _ in range(300_000)]
    rows = spark.createDataFrame(records, "record string").coalesce(1).selectExpr("record", "1L as deal", "monotonically_increasing_id() as place")
    path = scratch_path(spark, "packed")
    write_documents(rows, COLUMNS, path, "deal", "place", documents=1, compression=COMPRESSION)
    own = reading_session(spark)
    own.conf.set("spark.sql.files.maxPartitionBytes", "150000")
    export = Export.open(own, path, 0)
    assert export.split.structure.places.count() > 2
    found = export.records().selectExpr("position", "to_json(record) as record").orderBy("position").collect()
    assert [(row["record"],) for row in found] == records
    assert [row["position"] for row in found] == list(range(len(records)))
