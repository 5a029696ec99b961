"""The whole run on small documents."""

import contextlib
import io

import pytest

import recordloom
from recordloom.operators.records import create_dataframe
from recordloom.plans.catalogue import registrations
from recordloom.plans.documents import DOCUMENT_LINES, write_documents
from recordloom.plans.profiles import VEHICLE_REGISTRATIONS, Profile
from recordloom.sources.envelope import Export, land, preview, read_documents
from recordloom.sources.errors import BrokenExport, EmptyExport, MixedMetadata
from recordloom.sources.scratch import scratch_path

COLUMNS = [
    {"fieldName": "id", "dataTypeName": "text"},
    {"fieldName": "year", "dataTypeName": "number"},
    {"fieldName": "expected_date", "dataTypeName": "calendar_date"},
    {"fieldName": "_reason", "dataTypeName": "checkbox"},
]
DATA = [
    [" a ", "2001", "2023-01-02T03:04:05", "t"],
    ["a", 2003, " 2023-01-02T03:04:05", "no"],
    [None, "x", None, None],
    ["b", None, "2023-01-02", True],
    ["short"],
    ["long", 1, 2, 3, 4],
    None,
    {"id": 1, "year": 2, "expected_date": 3, "_reason": 4},
    "four",
]
PROFILE = Profile(
    keys=("id", "year"),
    unique="id",
    required=("id",),
    allowed=("year", "id", "gone", "_reason", "expected_date_parsed"),
    ranges={"year": "year"},
    dates=("expected_date",),
)


@pytest.mark.parametrize("whole_document_bytes", [0, 10**9])
def test_run(spark, document, whole_document_bytes):
    path = document(DATA, COLUMNS)
    run = recordloom.run(spark, path, PROFILE, whole_document_bytes=whole_document_bytes)
    assert run.curated.columns == ["year", "id", "_reason", "expected_date_parsed"]
    found = {(r["id"], r["year"], r["_reason"], str(r[3])) for r in run.curated.collect()}
    assert found == {
        ("a", 2001.0, True, "2023-01-02"),
        ("a", 2003.0, False, "None"),
        ("b", None, True, "None"),
    }
    assert run.report().first().asDict() == {
        "id_nulls": 1,
        "year_nulls": 2,
        "total_rows": 4,
        "distinct_id": 4,
        "has_duplicates": False,
        "min_year": 2001.0,
        "max_year": 2003.0,
        "expected_date_failures": 2,
    }
    rejects = {(r["reason"], r["raw"]) for r in run.rejects().collect()}
    assert rejects == {
        ("too short", '["short"]'),
        ("too long", '["long",1,2,3,4]'),
        ("null record", "null"),
        ("not an array", '{"_reason":4,"expected_date":3,"id":1,"year":2}'),
        ("not an array", '"four"'),
    }
    drift = {tuple(r) for r in run.drift().collect()}
    assert drift == {("expected_date", "dropped"), ("gone", "missing")}
    kept = run.publish("spark_catalog", "default", f"run_{whole_document_bytes}", fmt="parquet")
    assert kept == 3
    assert spark.table(f"run_{whole_document_bytes}").count() == 3


def test_positions_of_rejects(spark, document):
    run = recordloom.run(spark, document(DATA, COLUMNS), PROFILE)
    rows = run.rejects().orderBy("position").collect()
    assert [r["position"] for r in rows] == [4, 5, 6, 7, 8]
    assert all(r["source"].endswith("export.json") for r in rows)


@pytest.mark.parametrize("size", [0, 10**9])
def test_lenient_json(spark, document, size):
    text = '{"meta": {"view": {"columns": [{"fieldName": "x", "dataTypeName": "number"}, {}]}}, '
    text += '"data": [[NaN, {"k": 1, "k": [2]}], [-Infinity, 1e400], [1e400, "NaN"]]}'
    before = spark.conf.get("spark.sql.variant.allowDuplicateKeys")
    staged = recordloom.stage(spark, document(None, None, text=text), whole_document_bytes=size)
    assert {str(tuple(r)) for r in staged.rows.collect()} == {
        "(nan, '{\"k\":[2]}')",
        "(-inf, 'Infinity')",
        "(inf, 'NaN')",
    }
    assert spark.conf.get("spark.sql.variant.allowDuplicateKeys") == before


def test_staging_where_told(spark, document, tmp_path):
    target = str(tmp_path / "staged")
    staged = recordloom.stage(spark, document(DATA, COLUMNS), target)
    assert staged.rows.columns == ["id", "year", "expected_date", "_reason"]
    assert spark.read.parquet(target).count() == len(DATA)


@pytest.mark.parametrize("size", [0, 10**9])
@pytest.mark.parametrize(
    "text",
    [
        '{"meta": {"view": {"columns": [{"fieldName": "a"}]}}, "data": []}',
        '{"meta": {"view": {"columns": [{"fieldName": "a"}]}}, "data": null}',
        '{"meta": {"view": {"columns": [{"fieldName": "a"}]}}}',
        '{"meta": {"view": {"columns": []}}, "data": [["x"]]}',
        '{"meta": {"view": {}}, "data": [["x"]]}',
        '{"meta": {}, "data": [["x"]]}',
        '{"data": [["x"]]}',
    ],
)
def test_empty_exports(spark, document, text, size):
    with pytest.raises(EmptyExport):
        recordloom.stage(spark, document(None, None, text=text), whole_document_bytes=size)


def test_one_bad_document_among_many(spark, document):
    good = document([["x"]], COLUMNS[:1], "good.json")
    empty = document([], COLUMNS[:1], "empty.json")
    with pytest.raises(EmptyExport):
        recordloom.stage(spark, [good, empty])
    other = document([["x"]], [{"fieldName": "other"}], "other.json")
    with pytest.raises(MixedMetadata):
        recordloom.stage(spark, [good, other])
    cut = document(None, None, "cut.json", text='{"meta": {"view": {"columns": [{"fieldName"')
    with pytest.raises(BrokenExport):
        recordloom.stage(spark, [good, cut])


def test_many_documents_are_checked_on_the_way(spark, document):
    def paths(last):
        good = [document([["x"]], COLUMNS[:1], f"{i}.json") for i in range(7)]
        return [*good, document(None, None, "last.json", text=last)]

    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        for last, error in [
            ('{"meta": {"view": {"columns": [{"fieldName": "id", "dataTypeName": "text"}]}}, "data": [["y"]]}', None),
            ('{"meta": {"view": {"columns": [{"fieldName": "id", "dataTypeName": "text"}]}}, "data": []}', EmptyExport),
            ('{"meta": {"view": {"columns": [{"fieldName": "no"}]}}, "data": [["y"]]}', MixedMetadata),
            ('{"data": [["y"]]}', EmptyExport),
        ]:
            batch = paths(last)
            assert not Export.open(spark, batch).few
            if error is None:
                assert recordloom.stage(spark, batch).rows.count() == 8
            else:
                with pytest.raises(error):
                    recordloom.stage(spark, batch)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_small_and_large_documents_staged_together(spark, document):
    small = [document([["x"], None], COLUMNS[:1], f"{i}.json") for i in range(9)]
    large = document([[str(i)] for i in range(300)], COLUMNS[:1], "large.json")
    other = document([[str(i)] for i in range(300)], COLUMNS[1:2], "other.json")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        assert not Export.open(spark, [*small, large], 1000).few
        staged = recordloom.stage(spark, [*small, large], whole_document_bytes=1000)
        with pytest.raises(MixedMetadata):
            recordloom.stage(spark, [*small, other], whole_document_bytes=1000)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert staged.rows.count() == 309
    assert staged.rejects.count() == 9


def test_errors_come_before_the_write(spark, document):
    path = document(DATA, COLUMNS)
    staged = recordloom.stage(spark, path)
    with pytest.raises(ValueError, match="absent"):
        recordloom.curate(staged, Profile(("absent",), "id", ("id",), ("id",)))
    with pytest.raises(ValueError, match="nothing to select"):
        recordloom.curate(staged, Profile(("id",), "id", ("id",), ("absent",)))


def test_landed_records_keep_their_types(spark, document, tmp_path):
    export = Export.open(spark, document(DATA, COLUMNS))
    landed = land(export, str(tmp_path / "landed"))
    text = "to_json(record) AS r"
    assert sorted(landed.selectExpr("position", text).collect()) == sorted(
        export.records().selectExpr("position", text).collect()
    )
    rows = create_dataframe(landed, recordloom.build_schema(COLUMNS)).collect()
    assert sorted(r["year"] or 0 for r in rows) == [0, 0, 2001.0, 2003.0]
    with pytest.raises(EmptyExport):
        land(Export.open(spark, document([], COLUMNS)), str(tmp_path / "none"))


def test_preview(spark, document):
    export = Export.open(spark, document(DATA, COLUMNS))
    assert preview(export.records(), 2).count() == 2
    assert preview(read_documents(spark, document(DATA, COLUMNS))).count() == 1


def test_shipped_profile():
    assert len(VEHICLE_REGISTRATIONS.allowed) == 16
    assert set(VEHICLE_REGISTRATIONS.required) < set(VEHICLE_REGISTRATIONS.keys)


def test_documents_are_cut_at_their_line_limit(spark):
    path = scratch_path(spark, "many")
    rows = DOCUMENT_LINES * 2 + 3
    records = spark.range(0, rows, 1, 1).selectExpr("'[' || id || ']'")
    write_documents(records, COLUMNS[:1], path)
    export = Export.open(spark, path)
    export.check()
    assert export.whole.count() == 3
    assert export.records().selectExpr("to_json(record)").distinct().count() == rows


def plan(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def test_plans(spark):
    run = registrations(spark, "/root/testdata/sf0.001")
    text = plan(run.curated)
    assert "IsNotNull(vin_1_10), IsNotNull(dol_vehicle_id)" in text
    assert "Python" not in text and "Exchange" not in text
    report = plan(run.report())
    assert report.count("Scan parquet") == plan(run.curated).count("Scan parquet")
    schema = next(line for line in report.splitlines() if line.startswith("ReadSchema"))
    assert "county" not in schema and "vin_1_10" in schema
    for df in (run.rejects(), run.duplicates(), run.staged.rows):
        assert "Python" not in plan(df)


def test_split_reading_shuffles_text_once(spark, document):
    path = document([[str(i), [i]] for i in range(50)], COLUMNS[:2])
    scan = Export.open(spark, path, whole_document_bytes=0).split
    read = plan(scan.records, "simple")
    assert "Python" not in read
    # The text of the lists is not shuffled when they are opened; the small side is sent.
    assert read.count("Exchange") == read.count("BroadcastExchange")


def test_typing_stays_in_the_engine(spark, document):
    export = Export.open(spark, document(DATA, COLUMNS))
    schema = recordloom.build_schema(export.columns())
    text = plan(create_dataframe(export.records(), schema))
    assert "Python" not in text and "Scan text" in text


@pytest.mark.parametrize("size", [0, 10**9])
def test_a_failed_batch_leaves_the_staging_table_alone(spark, document, tmp_path, size):
    target = str(tmp_path / "staged")
    good = document([["x"]] * 7, COLUMNS[:1], "good.json")
    assert recordloom.stage(spark, good, target, size).rows.count() == 7
    other = document([["x"]], [{"fieldName": "other"}], "other.json")
    with pytest.raises(MixedMetadata):
        recordloom.stage(spark, [good, other], target, size)
    assert spark.read.parquet(target).count() == 7
    assert [p.name for p in tmp_path.iterdir() if p.name.startswith("staged")] == ["staged"]


@pytest.mark.parametrize("size", [0, 10**9])
def test_repeated_keys_count_alike_everywhere(spark, document, tmp_path, size):
    text = '{"meta": {"view": {"columns": [{"fieldName": "a"}]}}, "data": [[{"k": 1, "k": 2}]]}'
    path = document(None, None, text=text)
    before = spark.conf.getAll
    export = Export.open(spark, path, size)
    kept = ['{"k":2}']
    assert [r["a"] for r in recordloom.stage(spark, path, whole_document_bytes=size).rows.collect()] == kept
    schema = recordloom.build_schema(export.columns())
    assert [r["a"] for r in create_dataframe(export.records(), schema).collect()] == kept
    landed = land(export, str(tmp_path / "landed"))
    assert [r["a"] for r in create_dataframe(landed, schema).collect()] == kept
    assert spark.conf.getAll == before


def test_an_empty_input_has_the_schema(spark):
    schema = recordloom.build_schema(COLUMNS)
    empty = spark.createDataFrame([], "source string, position bigint, record variant")
    rows = create_dataframe(empty, schema)
    assert rows.schema == schema and rows.count() == 0


def test_the_staged_table_can_be_dropped(spark, document, tmp_path):
    run = recordloom.run(spark, document(DATA, COLUMNS), PROFILE, str(tmp_path / "staged"))
    run.close()
    assert not (tmp_path / "staged").exists()
