"""The bucketed key index: no shuffle of stored keys, and the same loads as without it."""

import pytest
from pyspark.sql import functions as F

import gaugeworks.plans.ingest as ingest
from gaugeworks.operators import load
from gaugeworks.plans.ingest import run_ingest
from gaugeworks.session import setting
from gaugeworks.sources.keyindex import KeyIndex, index_width, rebuild, stored_keys
from gaugeworks.sources.spec import SourceSpec
from gaugeworks.sources.tables import read_run_events, read_table
from tests.test_ingest import HEADER
from tests.test_plans import plan


def rows(keys, value=1):
    return HEADER + "".join(f"{k},365,PM2.5,Mean,mcg,CD,101,Bronx,Winter,2008-12-01,{value},\n" for k in keys)


@pytest.fixture
def index(spark, tmp_path):
    index = KeyIndex(str(tmp_path / "keys"), 8)
    index.write(spark.range(0, 4000, 2).withColumnRenamed("id", "unique_id"), "a")
    index.write(spark.range(1, 1000, 2).withColumnRenamed("id", "unique_id"), "b")
    return index


def _batch(spark):
    ids = spark.range(6000).select((F.col("id") % 3000).cast("int").alias("unique_id"), F.col("id").alias("at"), F.lit("x").alias("message"))
    return ids.repartition(5)


@pytest.mark.parametrize("rows", [None, 2_000_000])
def test_a_batch_of_any_size_shuffles_no_stored_key(spark, index, rows):
    with index.as_wide(spark), setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        fresh = load.new_rows(_batch(spark), None, "unique_id", ["at"], (0, 2999), rows, index.read(spark, ["a", "b"]))
        text = plan(fresh, "simple")
        ids = sorted(r.unique_id for r in fresh.collect())
    stored = text[text.index("LeftAnti") :]
    scan = next(line for line in stored.splitlines() if "FileScan" in line)
    assert "Bucketed: true" in scan and "GreaterThanOrEqual(unique_id,0), LessThanOrEqual(unique_id,2999)" in scan
    # Two exchanges: the batch in this test is dealt out once by hand and once by key. The stored side has none.
    exchanges = [line for line in text.splitlines() if "Exchange" in line]
    assert len(exchanges) == 2 and sum("hashpartitioning(unique_id" in line and ", 8)" in line for line in exchanges) == 1
    assert text.count("WindowGroupLimit") == 2
    assert ids == list(range(1001, 3000, 2))


def test_first_row_wins_and_other_keys_count(spark, index):
    existing = spark.createDataFrame([(1001,), (1003,)], "unique_id int")
    with index.as_wide(spark):
        fresh = load.new_rows(_batch(spark), existing, "unique_id", ["at"], None, None, index.read(spark, ["a", "b"])).collect()
    assert sorted(r.unique_id for r in fresh) == list(range(1005, 3000, 2))


def test_only_the_named_attempts_are_read(spark, index):
    assert index.read(spark, ["b"]).count() == 500 and index.read(spark, ["b", "a"]).count() == 2500
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("keys_")]


@pytest.mark.parametrize("buckets", [0, 4])
def test_loads_are_the_same_with_and_without_an_index(spark, tmp_path, buckets):
    home = str(tmp_path / "home")
    for run, keys in (("r1", [1, 2, 2, 5]), ("r2", [2, 3, 1]), ("r3", []), ("r4", [9, 5, 7, 9])):
        path = tmp_path / f"{run}.csv"
        path.write_text(rows(keys, run[1]))
        report = run_ingest(spark, SourceSpec(path=str(path)), home, run, key_buckets=buckets if run == "r1" else None)
        assert report.valid_records == len(keys)
    found = read_table(spark, home, "measurements").select("unique_id", "data_value", "run_id").collect()
    assert sorted(map(tuple, found)) == [(1, 1.0, "r1"), (2, 1.0, "r1"), (3, 2.0, "r2"), (5, 1.0, "r1"), (7, 4.0, "r4"), (9, 4.0, "r4")]
    assert index_width(spark, home) == buckets


def test_rebuild_covers_all_loads_so_far(spark, tmp_path):
    home = str(tmp_path / "home")

    def run(name, keys, **how):
        (tmp_path / f"{name}.csv").write_text(rows(keys))
        return run_ingest(spark, SourceSpec(path=str(tmp_path / f"{name}.csv")), home, name, **how).inserted_records

    rebuild(spark, home, 4)
    assert run("a", [1, 2], key_buckets=0) == 2
    assert run("b", [2, 3]) == 1  # the empty index of four buckets, and a's facts
    stored = stored_keys(spark, home, 4)
    assert stored.others.count() == 2 and stored.indexed.count() == 1
    rebuild(spark, home, 4)
    stored = stored_keys(spark, home, 4)
    assert stored.others is None and sorted(r[0] for r in stored.indexed.collect()) == [1, 2, 3]
    assert run("c", [3, 4]) == 1 and run("d", [1, 4, 5], key_buckets=2) == 1  # another width: nothing is indexed so yet
    rebuild(spark, home, 2)
    stored = stored_keys(spark, home, 2)
    assert stored.others is None and sorted(r[0] for r in stored.indexed.collect()) == [1, 2, 3, 4, 5]
    assert run("e", [5, 6, 1]) == 1


def test_keys_of_a_failed_load_do_not_count(spark, tmp_path, monkeypatch):
    home, spec = str(tmp_path / "home"), SourceSpec(path=str(tmp_path / "a.csv"))
    (tmp_path / "a.csv").write_text(rows([1, 2]))
    monkeypatch.setattr(ingest, "reject_rows", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_ingest(spark, spec, home, "r", key_buckets=4)
    assert stored_keys(spark, home, 4).indexed is None
    monkeypatch.undo()
    assert run_ingest(spark, spec, home, "r", key_buckets=4).inserted_records == 2
    assert stored_keys(spark, home, 4).indexed.count() == 2
    assert {r.key_buckets for r in read_run_events(spark, home).filter("status = 'SUCCESS'").collect()} == {4}
