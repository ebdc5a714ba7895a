"""End to end: dirty files to tables, repeated loads, failed loads."""

import json

import pytest
from pyspark.sql import functions as F

from gaugeworks.plans.ingest import run_ingest
from gaugeworks.plans.integrity import check_warehouse
from gaugeworks.sources.spec import RuleSet, SourceSpec
from gaugeworks.sources.tables import read_run_events, read_table

HEADER = (
    "Unique ID,Indicator ID,Name,Measure,Measure Info,Geo Type Name,Geo Join ID,"
    "Geo Place Name,Time Period,Start_Date,Data Value,Message\n"
)
A = HEADER + (
    "1,365,PM2.5,Mean,mcg,CD,101,Bronx,Winter,12/01/2008,10.5,\n"
    "2,365,Other,Mean,mcg,CD,102, Queens ,Summer,2009-06-01,11,hello\n"
    "3,375,NO2,Mean,ppb,CD,,Bronx,Summer,06/01/2009,NA,\n"
)
B = HEADER + (
    "1,365,PM2.5,Mean,mcg,CD,101,Bronx,Winter,2008-12-01,99,copy\n"
    "4,365,PM2.5,Mean,mcg,CD,101,Bronx late,Winter,2008-12-01,7,\n"
    "5,365,,Mean,mcg,CD,101,Bronx,Winter,2008-12-01,7,\n"
    "x,365,PM2.5,Mean,mcg,CD,101,Bronx,Winter,2008-12-01,7,\n"
    "6,365,PM2.5,Mean,mcg,CD,101,Bronx,Winter,2008-12-01,abc,\n"
    "7,365,PM2.5,Mean,mcg,CD,101,Bronx,Winter,2020-02-30,7,\n"
    "8,365,PM2.5,Mean,mcg,CD,U1,Bronx,Winter,2008-12-01,7,\n"
    "9,365,PM2.5,Mean,mcg,CD,101,Bronx,Winter,2008-12-01,7,,surplus\n"
)


@pytest.fixture
def files(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(A)
    (tmp_path / "in" / "b.csv").write_text(B)
    return str(tmp_path / "in")


def test_load_reload_and_audit(spark, files, tmp_path):
    home = str(tmp_path / "home")
    report = run_ingest(spark, SourceSpec(path=files), home, "r1")
    assert (report.total_records, report.valid_records, report.rejected_records) == (11, 5, 6)
    assert (report.inserted_records, report.skipped_records) == (4, 1)

    fact = {r.unique_id: r for r in read_table(spark, home, "measurements").collect()}
    assert sorted(fact) == [1, 2, 3, 4]
    assert fact[1].data_value == 10.5 and str(fact[1].start_date) == "2008-12-01"
    assert fact[2].message == "hello" and fact[2].run_id == "r1" and fact[2].load_timestamp
    assert fact[3].data_value is None and fact[3].geo_join_id is None
    names = {r.indicator_id: r.name for r in read_table(spark, home, "indicators").collect()}
    assert names == {365: "PM2.5", 375: "NO2"}
    places = {r.geo_join_id: r.geo_place_name for r in read_table(spark, home, "geographic").collect()}
    assert places == {101: "Bronx", 102: "Queens"}

    rejects = read_table(spark, home, "ingestion_rejects").collect()
    assert sorted(r.error_reason for r in rejects) == [
        "Invalid date format for start_date",
        "Invalid integer field",
        "Invalid integer field",
        "Invalid numeric value for data_value",
        "Malformed row",
        "Missing required field: name",
    ]
    assert {r.source_file for r in rejects} == {"b.csv"}
    payload = json.loads(next(r.raw_record for r in rejects if "numeric" in r.error_reason))
    assert payload["data_value"] == "abc" and payload["message"] is None
    assert "error_reason" not in payload and not any(k.startswith("_") for k in payload)

    checks = check_warehouse(spark, home).collect()
    assert len(checks) == 12 and {c.violations for c in checks} == {0}

    again = run_ingest(spark, SourceSpec(path=files), home, "r2")
    assert (again.inserted_records, again.skipped_records) == (0, 5)
    assert read_table(spark, home, "measurements").count() == 4
    assert read_table(spark, home, "indicators").count() == 2

    retry = run_ingest(spark, SourceSpec(path=files), home, "r1")
    assert retry.inserted_records == 4 and read_table(spark, home, "measurements").count() == 4


def test_failed_load_is_logged_and_invisible(spark, files, tmp_path, monkeypatch):
    home = str(tmp_path / "home")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_ingest(spark, SourceSpec(path=str(tmp_path / "none.csv")), home, "gone")
    run = read_table(spark, home, "ingestion_runs").filter("run_id = 'gone'").first()
    assert run.status == "FAILED" and run.total_records == 0 and "none.csv" in run.error_message

    import gaugeworks.plans.ingest as plan

    monkeypatch.setattr(plan, "reject_rows", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_ingest(spark, SourceSpec(path=files), home, "half")
    assert read_table(spark, home, "measurements").count() == 0
    assert read_table(spark, home, "indicators").count() == 0
    run = read_table(spark, home, "ingestion_runs").filter("run_id = 'half'").first()
    assert run.status == "FAILED" and run.total_records == 11 and run.end_timestamp >= run.start_timestamp
    monkeypatch.undo()
    run_ingest(spark, SourceSpec(path=files), home, "half")
    assert read_table(spark, home, "measurements").count() == 4
    assert read_run_events(spark, home).filter("run_id = 'half'").count() == 4


def test_failing_retry_leaves_a_committed_run_alone(spark, files, tmp_path, monkeypatch):
    home = str(tmp_path / "home")
    first = run_ingest(spark, SourceSpec(path=files), home, "r1")
    import gaugeworks.plans.ingest as plan

    monkeypatch.setattr(plan, "reject_rows", lambda *a: 1 / 0)
    assert run_ingest(spark, SourceSpec(path=files), home, "r1") == first
    with pytest.raises(ZeroDivisionError):
        run_ingest(spark, SourceSpec(path=files + "/b.csv"), home, "r2")
    for table, rows in (("measurements", 4), ("indicators", 2), ("geographic", 2), ("ingestion_rejects", 6)):
        assert read_table(spark, home, table).count() == rows


def test_stored_rows_are_read_without_a_shuffle(spark, files, tmp_path):
    home = str(tmp_path / "home")
    for run in range(3):
        run_ingest(spark, SourceSpec(path=files), home, f"r{run}")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        plan = read_table(spark, home, "measurements")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange" not in plan and "Join" not in plan


def test_forced_reject(spark, files, tmp_path):
    report = run_ingest(spark, SourceSpec(path=files + "/a.csv"), str(tmp_path / "home"), force_reject=True)
    assert (report.total_records, report.rejected_records) == (4, 1)


def test_dedup_without_fact_key(spark, files, tmp_path):
    spec = SourceSpec(path=files, dedup_keys=["indicator_id", "start_date"])
    home = str(tmp_path / "home")
    run_ingest(spark, spec, home)
    ids = [r[0] for r in read_table(spark, home, "measurements").select("unique_id").orderBy("unique_id").collect()]
    assert ids == [1, 2, 3]


def test_first_wins_follows_file_order_not_size(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    row = "{},1,n,m,i,t,1,p{},w,2020-01-01,{},\n"
    (folder / "a.csv").write_text(HEADER + row.format(1, "a", 1))
    (folder / "b.csv").write_text(HEADER + "".join(row.format(1, "b" * 40, i) for i in range(2, 5)))
    home = str(tmp_path / "home")
    run_ingest(spark, SourceSpec(path=str(folder)), home)
    assert read_table(spark, home, "measurements").first().data_value == 1
    assert read_table(spark, home, "geographic").first().geo_place_name == "pa"


def test_json_source(spark, tmp_path):
    rows = [
        {"unique_id": 1, "indicator_id": 2, "name": "n", "geo_type_name": "t", "geo_place_name": "p",
         "start_date": "2020-01-01", "data_value": 1.5},
        {"unique_id": 2, "indicator_id": 2, "name": None, "geo_type_name": "t", "geo_place_name": "p",
         "start_date": "2020-01-01", "data_value": 1.5},
    ]
    path = tmp_path / "in.json"
    path.write_text("\n".join(json.dumps(r) for r in rows) + "\n{broken\n")
    home = str(tmp_path / "home")
    report = run_ingest(spark, SourceSpec(path=str(path), format="json"), home)
    assert (report.total_records, report.valid_records) == (3, 1)
    reasons = [r.error_reason for r in read_table(spark, home, "ingestion_rejects").collect()]
    assert sorted(reasons) == ["Malformed row", "Missing required field: name"]
    array = tmp_path / "array.json"
    array.write_text(json.dumps(rows, indent=1))
    report = run_ingest(spark, SourceSpec(path=str(array), format="json", multiline=True), str(tmp_path / "h2"))
    assert (report.total_records, report.valid_records) == (2, 1)


def test_custom_mapping_and_rules(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("ID;Kind;Label\n1;7;a\n2.0;7;b\n")
    spec = SourceSpec(
        path=str(path),
        delimiter=";",
        mapping={"id": "unique_id", "kind": "indicator_id", "label": "name"},
        rules=RuleSet(required=["name"], lenient_int=True),
    )
    report = run_ingest(spark, spec, str(tmp_path / "home"))
    assert report.valid_records == 2
    strict = SourceSpec(path=str(path), delimiter=";", mapping=spec.mapping, rules=RuleSet(required=["name"]))
    assert run_ingest(spark, strict, str(tmp_path / "h2")).valid_records == 1
    dims = read_table(spark, str(tmp_path / "home"), "indicators").filter(F.col("indicator_id") == 7)
    assert dims.first().name == "a"


def test_header_only_file(spark, tmp_path):
    (tmp_path / "x.csv").write_text(HEADER)
    report = run_ingest(spark, SourceSpec(path=str(tmp_path / "x.csv")), str(tmp_path / "home"), "empty")
    assert (report.status, report.total_records, report.inserted_records) == ("SUCCESS", 0, 0)
    assert read_table(spark, str(tmp_path / "home"), "measurements").count() == 0


def test_run_id_must_be_a_plain_name(spark, files, tmp_path):
    with pytest.raises(ValueError, match="run id"):
        run_ingest(spark, SourceSpec(path=files), str(tmp_path / "home"), "a/b")


def test_skewed_copies(spark, tmp_path):
    """A third of all rows are copies of one key; a third of them share one place."""
    row = "{},1,n,m,i,t,{},p{},w,2020-01-01,{},\n"
    lines = [row.format(7 if i % 3 == 0 else i + 10, 5 if i % 3 == 1 else i % 9, i, i) for i in range(9000)]
    (tmp_path / "in").mkdir()
    for part in range(3):
        (tmp_path / "in" / f"{part}.csv").write_text(HEADER + "".join(lines[part * 3000 : (part + 1) * 3000]))
    report = run_ingest(spark, SourceSpec(path=str(tmp_path / "in")), str(tmp_path / "home"))
    assert (report.inserted_records, report.skipped_records) == (6001, 2999)
    facts = read_table(spark, str(tmp_path / "home"), "measurements")
    assert facts.filter("unique_id = 7").first().data_value == 0
    places = {r.geo_join_id: r.geo_place_name for r in read_table(spark, str(tmp_path / "home"), "geographic").collect()}
    assert places[5] == "p1" and places[0] == "p0" and sorted(places) == [0, 2, 3, 5, 6, 8]
