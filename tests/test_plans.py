"""Physical plans: what is pushed down, pre-aggregated, broadcast and compiled."""

import contextlib
import io
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import audit, dedupe, joins, load, rejects, stats
from gaugeworks.operators.features import group_deviation, group_profile
from gaugeworks.operators.validate import tag_records
from gaugeworks.plans import testtables as data
from gaugeworks.plans.ingest import run_ingest
from gaugeworks.plans.integrity import check_warehouse
from gaugeworks.plans.workload import QUERIES
from gaugeworks.session import shuffle_width
from gaugeworks.sources.files import scan_source
from gaugeworks.sources.spec import SourceSpec
from tests.test_ingest import A

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not present")


def plan(df, mode="formatted"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


@needs_tables
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "Pandas"):
        assert operator not in text


@needs_tables
def test_filter_and_columns_reach_the_scan(spark):
    rows = data.table(spark, FOLDER, "orders").withColumnRenamed("o_custkey", "indicator_id")
    text = plan(joins.for_indicator(rows, 7).select("o_totalprice"))
    assert "PushedFilters: [IsNotNull(o_custkey), EqualTo(o_custkey,7)]" in text
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in text


@needs_tables
def test_first_wins_sheds_rows_before_the_shuffle(spark):
    lines = data.table(spark, FOLDER, "lineitem")
    text = plan(dedupe.dedupe_first(lines, ["l_orderkey"], ["l_shipdate"]), "simple")
    limits = [line for line in text.splitlines() if "WindowGroupLimit" in line]
    assert "Final" in limits[0] and "Partial" in limits[1] and text.index("Exchange") < text.index("Partial")


@needs_tables
def test_append_shuffles_the_batch_once(spark, tmp_path):
    facts = data.fact(spark, FOLDER)
    facts.write.parquet(str(tmp_path / "stored"))
    stored = spark.read.parquet(str(tmp_path / "stored"))
    batch = data.table(spark, FOLDER, "orders").select(F.col("o_orderkey").alias("unique_id"), "o_totalprice")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(load.new_rows(batch, stored, "unique_id", ["o_totalprice"], (5, 9)), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange") == 2 and "LeftAnti" in text
    assert "GreaterThanOrEqual(unique_id,5), LessThanOrEqual(unique_id,9)" in text
    assert "ReadSchema: struct<unique_id:bigint>" in text


@needs_tables
def test_small_batches_cut_the_stored_keys_before_any_shuffle(spark):
    stored = data.table(spark, FOLDER, "orders").select(F.col("o_orderkey").alias("unique_id"))
    batch = data.table(spark, FOLDER, "orders").select(F.col("o_orderkey").alias("unique_id"), "o_totalprice").limit(50)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(load.new_rows(batch, stored, "unique_id", ["o_totalprice"], (5, 9), 50), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    stored_side = text[text.index("LeftAnti") :].split("LeftSemi")[0]
    assert "BroadcastHashJoin" in text and "LeftSemi" in text
    assert stored_side.rindex("Exchange") < stored_side.rindex("BroadcastHashJoin")


@needs_tables
def test_aggregates_have_a_map_side_part(spark):
    places = data.places(spark, FOLDER)
    for df in (
        stats.group_mean(places),
        stats.correlation(places, "geo_join_id", "data_value"),
        audit.pk_violations(places, "geo_join_id"),
        audit.dimension_conflicts(places, "geo_join_id", ["geo_place_name"]),
        dedupe.count_duplicates(places, ["geo_join_id"]),
    ):
        assert "partial_" in plan(df, "simple")
    assert "TakeOrderedAndProject" in plan(stats.top_groups(places), "simple")


@needs_tables
def test_deviation_broadcasts_the_settled_means_only(spark):
    rows = data.places(spark, FOLDER).select("geo_place_name", "data_value")
    profile = group_profile(rows, "geo_place_name", "data_value")
    text = plan(group_deviation(rows, profile=profile), "simple")
    assert "Window" not in text and "BroadcastHashJoin" in text
    assert "ResolvedHint" not in plan(group_deviation(rows, profile=profile), "extended")


@needs_tables
def test_orphan_check_counts_before_it_joins(spark):
    orders, customer = data.table(spark, FOLDER, "orders"), data.table(spark, FOLDER, "customer")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(audit.fk_orphans(orders, "o_custkey", customer, "c_custkey"), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.index("LeftAnti") < text.index("partial_count")


def test_an_audit_reads_each_table_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text(A)
    run_ingest(spark, SourceSpec(path=str(tmp_path / "a.csv")), str(tmp_path / "home"), "r")
    checks = check_warehouse(spark, str(tmp_path / "home"))
    assert plan(checks, "simple").count("FileScan") == 5
    assert {r.violations for r in checks.collect()} == {0} and checks.count() == 12


def test_tagging_stays_below_the_compiled_method_limit(spark, tmp_path):
    """The JVM does not compile methods of more than 8000 bytes."""
    (tmp_path / "a.csv").write_text(A)
    spec = SourceSpec(path=str(tmp_path / "a.csv"))
    tagged = tag_records(scan_source(spark, spec), spec.rules, spec.null_tokens)
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", plan(tagged, "codegen"))]
    assert sizes and max(sizes) < 8000


def test_rejects_do_not_shuffle(spark):
    rows = spark.createDataFrame([(1, "bad", "x")], "pos int, error_reason string, name string")
    assert "Exchange" not in plan(rejects.reject_rows(rows, "r", ["pos"], F.lit("f")), "simple")


def test_shuffle_width_only_grows_and_is_put_back(spark):
    key, before = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    with shuffle_width(spark, 10):
        assert spark.conf.get(key) == before
    with shuffle_width(spark, 400_000_000):
        assert spark.conf.get(key) == "101"
    assert spark.conf.get(key) == before
