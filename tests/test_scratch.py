"""The shared folder of sessions on a cluster."""

import duckdb
import pytest

from recordloom.operators.schema import dedup_names
from recordloom.plans.catalogue import ORACLES, QUERIES
from recordloom.sources.scratch import scratch_path


@pytest.fixture
def cluster(spark, monkeypatch):
    """The session under the name of a cluster's master."""
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    return spark


def named(monkeypatch, spark, folder, master=None):
    """The session with another checkpoint folder, or none."""
    conf = type(spark.conf)
    get = conf.get
    monkeypatch.setattr(conf, "get", lambda self, key, *rest: folder if key == "spark.checkpoint.dir" else get(self, key, *rest))
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    if master:
        monkeypatch.setattr(spark.sparkContext, "master", master)


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_a_mounted_folder_serves_a_cluster(cluster, tmp_path, monkeypatch, scheme):
    named(monkeypatch, cluster, f"{scheme}{tmp_path}/shared")
    path = scratch_path(cluster, "some")
    assert path.startswith(f"{scheme}{tmp_path}/shared/some-")
    cluster.range(3).write.parquet(path)
    assert cluster.read.parquet(f"file://{path.split(':')[-1].replace('//', '/')}").count() == 3


@pytest.mark.parametrize("master", ["spark://host:7077", "local-cluster[2,1,1024]"])
def test_without_a_checkpoint_folder_the_warehouse_serves(spark, monkeypatch, master):
    named(monkeypatch, spark, None, master)
    warehouse = spark.conf.get("spark.sql.warehouse.dir").split(":")[-1].replace("//", "/")
    assert f"{warehouse}/recordloom-scratch/some-" in scratch_path(spark, "some")


def test_a_warehouse_that_nobody_named_does_not_serve_a_cluster(cluster, monkeypatch):
    named(monkeypatch, cluster, None)
    get = type(cluster.conf).get
    default = "spark-warehouse"
    monkeypatch.setattr(type(cluster.conf), "get", lambda self, key, *rest: default if key == "spark.sql.warehouse.dir" else get(self, key, *rest))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(cluster, "some")


def test_queries_run_on_a_cluster_with_a_mounted_folder(cluster, tmp_path):
    tables = {
        "nation": "select id as n_nationkey, concat('n', id) as n_name, id % 5 as n_regionkey from range(25)",
        "region": "select id as r_regionkey, concat('r', id) as r_name from range(5)",
        "customer": "select id as c_custkey, concat('c', id) as c_name, 'x' as c_mktsegment, id % 25 as c_nationkey, 1.5D as c_acctbal from range(40)",
        "orders": "select id as o_orderkey, id % 7 as o_custkey, 'F' as o_orderstatus, 2.5D as o_totalprice, timestamp'2024-01-02' as o_orderdate from range(40)",
    }
    for name, sql in tables.items():
        cluster.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    counts = {"envelope_columns": 25, "envelope_rows_split": 40, "landed_rows": 40, "flat_rows_split": 40, "admission_table": 16, "curated_table": 32}
    for name, count in counts.items():
        assert QUERIES[name](cluster, str(tmp_path)).count() == count
    pages = cluster.sql("select id, if(id % 2 = 0, 'a', 'a_1') as name from range(6)")
    assert dedup_names(pages, "name", "id", "new").select("new").distinct().count() == 6


@pytest.fixture(scope="module")
def small_tables(spark, tmp_path_factory):
    """The tables that the queries with scratch folders read, a few rows of each."""
    folder = tmp_path_factory.mktemp("small")
    tables = {
        "nation": "select id as n_nationkey, concat('n', id) as n_name, id % 5 as n_regionkey from range(25)",
        "region": "select id as r_regionkey, concat('r', id) as r_name from range(5)",
        "customer": "select id as c_custkey, concat('c', id) as c_name, 'x' as c_mktsegment, id % 25 as c_nationkey, 1.5D as c_acctbal from range(40)",
        "orders": "select id as o_orderkey, id % 7 as o_custkey, 'F' as o_orderstatus, 2.5D as o_totalprice, timestamp'2024-01-02' as o_orderdate from range(40)",
        "pages": "select id as page_id, concat('https://h', id % 3, '/x') as url from range(30)",
        "lineitem": """select id div 3 as l_orderkey, cast(id % 3 as int) as l_linenumber, id % 9 as l_suppkey, id % 11 as l_partkey, 1.5D as l_quantity,
                       2.5D as l_extendedprice, 'A' as l_returnflag, 'F' as l_linestatus, timestamp'2024-01-02' as l_shipdate from range(300)""",
    }
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(f"{folder}/{name}.parquet")
    duck = duckdb.connect()
    for name in tables:
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
    return str(folder), duck


WITH_SCRATCH = [
    "appended_table", "curated_table", "curation_duplicates", "curation_published", "curation_rejects", "curation_rejects_split", "curation_report",
    "curation_run", "curation_run_split", "envelope_columns", "envelope_rows", "envelope_rows_split", "first_records", "flat_rows_split",
    "landed_rows", "name_dedup",
]


@pytest.mark.parametrize("name", WITH_SCRATCH)
def test_each_query_with_scratch_runs_on_a_cluster(cluster, small_tables, tmp_path, monkeypatch, name):
    folder, duck = small_tables
    named(monkeypatch, cluster, f"file://{tmp_path}/shared")
    expected = len(duck.execute(ORACLES[name]).fetchall())
    assert len(QUERIES[name](cluster, folder).collect()) == expected > 0
