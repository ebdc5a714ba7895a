"""Files are loaded once each, in the order they arrive."""

import os
import shutil
import time

from gaugeworks.sources.spec import SourceSpec
from gaugeworks.sources.tables import read_table
from gaugeworks.streaming.arrivals import load_arrivals
from tests.test_ingest import A, B


def test_new_files_are_loaded_once(spark, tmp_path):
    folder, home = tmp_path / "in", str(tmp_path / "home")
    folder.mkdir()
    (folder / "a.csv").write_text(A)
    spec = SourceSpec(path=str(folder), name="drop")
    load_arrivals(spark, spec, home).awaitTermination()
    assert read_table(spark, home, "measurements").count() == 3
    (folder / "b.csv").write_text(B)
    load_arrivals(spark, spec, home).awaitTermination()
    load_arrivals(spark, spec, home).awaitTermination()
    facts = {r.unique_id: r for r in read_table(spark, home, "measurements").collect()}
    assert sorted(facts) == [1, 2, 3, 4] and facts[1].data_value == 10.5
    runs = read_table(spark, home, "ingestion_runs").orderBy("run_id").collect()
    assert [(r.run_id.rsplit("-", 1)[1], r.status, r.total_records) for r in runs] == [("0", "SUCCESS", 3), ("1", "SUCCESS", 8)]
    assert all(r.run_id.startswith(f"{spec.key}-") for r in runs)
    assert read_table(spark, home, "ingestion_rejects").count() == 6


def test_old_files_and_lost_progress(spark, tmp_path):
    folder, home = tmp_path / "in", str(tmp_path / "home")
    folder.mkdir()
    (folder / "a.csv").write_text(A)
    spec = SourceSpec(path=str(folder))
    load_arrivals(spark, spec, home).awaitTermination()
    (folder / "b.csv").write_text(B)
    long_ago = time.time() - 30 * 86_400
    os.utime(folder / "b.csv", (long_ago, long_ago))
    (folder / "c.csv").write_text(A.replace("\n1,", "\n101,").replace("\n2,", "\n102,").replace("\n3,", "\n103,"))
    load_arrivals(spark, spec, home).awaitTermination()
    ids = {r.unique_id for r in read_table(spark, home, "measurements").collect()}
    assert ids == {1, 2, 3, 4, 101, 102, 103}
    shutil.rmtree(f"{home}/_progress")
    load_arrivals(spark, spec, home).awaitTermination()
    facts = read_table(spark, home, "measurements")
    assert facts.count() == 7 and {r.unique_id for r in facts.collect()} == ids
