"""Reading, header normalization, validation and duplicates on small records."""

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators.audit import dimension_conflicts, fk_orphans, not_null_violations, pk_violations
from gaugeworks.operators.dedupe import count_duplicates, dedupe_first
from gaugeworks.operators.load import GEOGRAPHIC_MAP, extract_dimension, fact_projection, new_rows
from gaugeworks.operators.mapping import inject_bad_row
from gaugeworks.operators.rejects import reject_rows, reject_samples, reject_summary, run_metrics
from gaugeworks.operators.validate import tag_records, validate
from gaugeworks.sources.files import normalize_headers, read_source, write_csv
from gaugeworks.sources.spec import DATES, NUMERIC, REQUIRED, RuleSet, SourceSpec

RECORD = (
    "unique_id int, indicator_id int, name string, geo_type_name string, geo_place_name string, "
    "start_date string, data_value double"
)
KEYS = ["unique_id", "indicator_id", "geo_place_name", "start_date"]
KEYED = "unique_id int, indicator_id int, geo_place_name string, start_date string, data_value double, pos int"


def read_text(spark, tmp_path, text, **options):
    path = tmp_path / "in.csv"
    path.write_text(text)
    names = text.splitlines()[0].split(options.get("delimiter", ","))
    mapping = {n.strip().lower().replace(" ", "_"): n.strip().lower().replace(" ", "_") for n in names}
    return read_source(spark, SourceSpec(path=str(path), mapping=mapping, **options))


def test_csv_rows_and_headers(spark, tmp_path):
    rows = read_text(
        spark,
        tmp_path,
        "Unique ID,Indicator ID,Geo Place Name,Start_Date,Data Value\n"
        "1,101,New York,2020-01-01,12.5\n2,102,Brooklyn,2020-02-01,8.1\n",
    )
    assert rows.count() == 2
    assert rows.columns[:5] == ["unique_id", "indicator_id", "geo_place_name", "start_date", "data_value"]


def test_csv_shapes(spark, tmp_path):
    rows = read_text(spark, tmp_path, 'A,B,C\n1,2\n1,2,3,4\n\n"q,1",2,3\n"say ""x""",b\\,"NA"\n')
    got = [(r.a, r.b, r.c, r._extra) for r in rows.orderBy("_row").collect()]
    assert got == [("1", "2", None, None), ("1", "2", "3", "4"), ("q,1", "2", "3", None), ('say "x"', "b\\", None, None)]


def test_csv_multiline_and_delimiter(spark, tmp_path):
    rows = read_text(spark, tmp_path, 'A;B\n"x\ny";2\n', delimiter=";", multiline=True)
    assert [(r.a, r.b) for r in rows.collect()] == [("x\ny", "2")]


def test_csv_without_header(spark, tmp_path):
    (tmp_path / "n.csv").write_text("1,x\n2,y\n")
    spec = SourceSpec(path=str(tmp_path / "n.csv"), has_header=False, mapping={"id": "unique_id", "n": "name"})
    assert sorted((r.unique_id, r.name) for r in read_source(spark, spec).collect()) == [("1", "x"), ("2", "y")]


def test_csv_empty_and_header_only(spark, tmp_path):
    assert read_text(spark, tmp_path, "A,B\n").count() == 0
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError, match="no columns"):
        read_source(spark, SourceSpec(path=str(tmp_path / "empty.csv")))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_source(spark, SourceSpec(path=str(tmp_path / "missing.csv")))


def test_header_collision(spark):
    assert normalize_headers(spark.createDataFrame([(1, 2)], ["Geo  Join-ID", " B "])).columns == ["geo__join-id", "b"]
    with pytest.raises(ValueError, match="equal after normalization"):
        normalize_headers(spark.createDataFrame([(1, 2)], ["A b", "a B"]))


def test_write_csv_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'a "quoted", text'), (2, None)], "i int, t string")
    write_csv(rows, str(tmp_path / "out"), single_file=True)
    back = spark.read.option("header", True).option("escape", '"').schema("i int, t string").csv(str(tmp_path / "out"))
    assert sorted(back.collect()) == sorted(rows.collect())


def test_all_valid(spark):
    rows = spark.createDataFrame(
        [(1, 101, "PM2.5", "City", "New York", "2020-01-01", 12.5), (2, 102, "PM10", "Borough", "B", "2020-02-01", 8.1)],
        RECORD,
    )
    valid, rejected = validate(rows)
    assert valid.count() == 2 and rejected.count() == 0
    assert dict(valid.dtypes)["start_date"] == "date" and dict(valid.dtypes)["unique_id"] == "int"


def test_absent_columns_are_missing(spark):
    rows = spark.createDataFrame(
        [(1, 101, "New York", 12.5)], "unique_id int, indicator_id int, geo_place_name string, data_value double"
    )
    valid, rejected = validate(rows)
    assert valid.count() == 0
    assert rejected.first().error_reason == "Missing required field: name"


def test_nan_value_is_accepted_as_null(spark):
    valid, rejected = validate(
        spark.createDataFrame([(1, 101, "n", "City", "New York", "2020-01-01", float("nan"))], RECORD)
    )
    assert rejected.count() == 0 and valid.first().data_value is None


def test_empty_input(spark):
    valid, rejected = validate(spark.createDataFrame([], RECORD))
    assert valid.count() == 0 and rejected.count() == 0


def test_first_rule_wins(spark):
    text = "unique_id string, indicator_id string, name string, geo_type_name string, geo_place_name string, "
    text += "geo_join_id string, start_date string, data_value string"
    good = ["1", "2", "n", "t", "p", "3", "2020-01-01", "1"]

    def bad(**changes):
        names = [part.split()[0] for part in text.split(", ")]
        return tuple(changes.get(name, value) for name, value in zip(names, good, strict=True))

    cases = [
        (bad(), None),
        (bad(unique_id=" ", name=None, data_value="x"), "Missing required field: unique_id"),
        (bad(name="\t", start_date=None), "Missing required field: name"),
        (bad(unique_id="1.5", data_value="x"), "Invalid integer field"),
        (bad(geo_join_id="U1"), "Invalid integer field"),
        (bad(geo_join_id=None), None),
        (bad(data_value="x", start_date="bad-date"), "Invalid numeric value for data_value"),
        (bad(data_value=None, start_date="bad-date"), "Invalid date format for start_date"),
        (bad(indicator_id="PM2.5"), "Invalid integer field"),
    ]
    rows = spark.createDataFrame([(*row, i) for i, (row, _) in enumerate(cases)], text + ", pos int")
    got = [r.error_reason for r in tag_records(rows).orderBy("pos").collect()]
    assert got == [reason for _, reason in cases]


def test_default_rules():
    for rules in (RuleSet(), RuleSet(required=[], numeric=[], dates=[])):
        assert (rules.required, rules.numeric, rules.dates) == (REQUIRED, NUMERIC, DATES)
    assert RuleSet(required=["x"]).required == ["x"]


def test_spec_from_config():
    spec = SourceSpec.from_config(
        {
            "app": {"name": "air"},
            "data_source": {"type": "file", "format": "csv", "path": "d.csv", "delimiter": "|", "encoding": "utf-8"},
            "schema_mapping": {"id": "unique_id"},
            "validation": {"required_fields": ["unique_id"], "numeric_fields": [], "date_fields": ["d"]},
            "deduplication": {"enabled": False, "keys": ["unique_id"]},
        }
    )
    assert (spec.name, spec.path, spec.delimiter, spec.dedup_keys) == ("air", "d.csv", "|", [])
    assert (spec.rules.required, spec.rules.numeric, spec.rules.dates) == (["unique_id"], NUMERIC, ["d"])
    with pytest.raises(ValueError, match="format"):
        SourceSpec(path="x", format="xml")


def keyed(spark, *rows):
    return spark.createDataFrame([(*row, i) for i, row in enumerate(rows)], KEYED)


def test_duplicates(spark):
    one, two = (1, 10, "NY", "2020-01-01", 12.3), (2, 10, "NY", "2020-01-01", 1.0)
    rows = keyed(spark, one, one, two, two)
    assert count_duplicates(rows, KEYS).first().duplicate_count == 2
    assert [r.pos for r in dedupe_first(rows, KEYS, ["pos"]).orderBy("pos").collect()] == [0, 2]
    assert dedupe_first(keyed(spark, one, two), KEYS, ["pos"]).count() == 2
    empty = spark.createDataFrame([], KEYED)
    assert dedupe_first(empty, KEYS, ["pos"]).count() == 0
    assert count_duplicates(empty, KEYS).first().duplicate_count == 0
    null = (None, 10, None, "2020-01-01", 1.0)
    assert count_duplicates(keyed(spark, null, null), KEYS).first().duplicate_count == 1
    for function in (lambda r: count_duplicates(r, KEYS), lambda r: dedupe_first(r, KEYS, ["pos"])):
        with pytest.raises(KeyError, match="geo_place_name"):
            function(empty.drop("geo_place_name"))


def test_dedupe_does_not_depend_on_partitions(spark):
    rows = spark.range(2000).select((F.col("id") % 7).alias("k"), (F.hash("id") % 1000).alias("o"), "id")
    want = dedupe_first(rows.coalesce(1), ["k"], ["o", "id"]).orderBy("k").collect()
    for n in (2, 5, 16):
        first = dedupe_first(rows.repartition(n), ["k"], ["o", "id"])
        assert first.orderBy("k").collect() == want
        assert dedupe_first(first, ["k"], ["o", "id"]).orderBy("k").collect() == want


def test_dimension_and_append(spark):
    rows = spark.createDataFrame(
        [(1, 0, "t", "a", 0), (2, 0, "t", "b", 1), (3, None, "t", "c", 2), (1, 5, "t", "d", 3)],
        "unique_id int, geo_join_id int, geo_type_name string, geo_place_name string, pos int",
    )
    dim = extract_dimension(rows, GEOGRAPHIC_MAP, "geo_join_id", ["pos"])
    assert sorted((r.geo_join_id, r.geo_place_name) for r in dim.collect()) == [(0, "a"), (5, "d")]
    facts = fact_projection(rows, "r", keep=["pos"])
    existing = spark.createDataFrame([(2,)], "unique_id int")
    fresh = new_rows(facts, existing, "unique_id", ["pos"], (1, 3))
    assert sorted((r.unique_id, r.geo_join_id) for r in fresh.collect()) == [(1, 0), (3, None)]
    assert [r.geo_join_id for r in dimension_conflicts(rows, "geo_join_id", ["geo_place_name"]).collect()] == [0]
    assert [(r.unique_id, r.row_count) for r in pk_violations(rows, "unique_id").collect()] == [(1, 2)]
    assert [r.row_count for r in pk_violations(rows, "geo_join_id").orderBy("geo_join_id").collect()] == [1, 2]
    orphans = fk_orphans(rows, "geo_join_id", dim.filter("geo_join_id = 5"), "geo_join_id")
    assert [(r.geo_join_id, r.row_count) for r in orphans.collect()] == [(0, 2)]
    nulls = not_null_violations(rows, ["geo_join_id", "unique_id"]).orderBy("column_name").collect()
    assert [tuple(r) for r in nulls] == [("geo_join_id", 1), ("unique_id", 0)]


def test_inject_bad_row(spark):
    rows = spark.createDataFrame([(2, "b"), (1, "a")], "pos int, name string")
    assert sorted(inject_bad_row(rows, ["pos"]).collect(), key=str) == sorted(
        [*rows.collect(), (1, None)], key=lambda r: str(spark.createDataFrame([tuple(r)], rows.schema).first())
    )


def test_reject_reports(spark):
    reasons = ["b", "a", "b", "a", "c", None, None, None, "d", "e", "f", None]
    rows = spark.createDataFrame(
        [(i, str(i), reason, 1.0 if i else float("nan")) for i, reason in enumerate(reasons)],
        "pos int, unique_id string, error_reason string, data_value double",
    )
    top = [(r.error_reason, r.reject_count, r.total_rejected) for r in reject_summary(rows, ["pos"]).collect()]
    assert top == [("Validation failed", 4, 12), ("b", 2, 12), ("a", 2, 12), ("c", 1, 12), ("d", 1, 12)]
    assert [r.unique_id for r in reject_samples(rows, ["pos"]).collect()] == ["0", "1", "2", "3", "4"]
    assert tuple(run_metrics(rows).first()) == (12, 4, 8)
    written = reject_rows(rows, "r1", ["pos"], F.lit("f.csv")).collect()
    assert len({r.reject_id for r in written}) == 12
    again = reject_rows(rows.repartition(3), "r1", ["pos"], F.lit("f.csv")).collect()
    assert {r.reject_id for r in again} == {r.reject_id for r in written}
    by_row = {r.raw_record: r for r in written}
    assert by_row['{"unique_id":"0","data_value":null}'].error_reason == "b"
    assert by_row['{"unique_id":"5","data_value":1.0}'].error_reason == "Unknown validation error"
