"""What the join keeps of a group of near copies grows with the group, and disk with the largest step."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gaugeworks.llm import ngram_join as nj
from gaugeworks.llm.shingles import shingle_sets
from tests.llm.test_ngram_join import _components, _near_copies


def test_runs_give_no_pair_lists(spark, odd):
    rows = [(s, s * 1000 + k, 400) for s in range(20) for k in range(30)]
    found = nj._runs(spark.createDataFrame(rows, "signature long, node long, size int"), 75)
    assert found.count() < 2 * len(rows)
    members = found.where(F.col("kind") == nj.MEMBER).groupBy("a").agg(F.collect_set("b").alias("b")).collect()
    assert sorted(sorted(r["b"]) for r in members) == [[s * 1000 + k for k in range(30)] for s in range(20)]


def test_equal_runs_of_a_task_come_once(spark, odd):
    rows = [(s, k, 400) for s in range(200) for k in range(5)]
    signed = spark.createDataFrame(rows, "signature long, node long, size int")
    found = nj._runs(signed, 75)
    assert found.where(F.col("kind") == nj.MEMBER).distinct().count() == 5
    assert found.count() <= 9 * int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize(("compared", "listed", "run"), [(3, 8, 2), (2048, 0, 2), (2048, 8, 4), (6, 1, 32)])
def test_long_and_crowded_runs(spark, odd, monkeypatch, compared, listed, run):
    monkeypatch.setattr(nj, "COMPARED", compared)
    monkeypatch.setattr(nj, "LISTED", listed)
    monkeypatch.setattr(nj, "RUN", run)
    monkeypatch.setattr(nj, "BLOCK", 4)
    rows = _near_copies(seed=11)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(repr, map(tuple, nj.ngram_join(df).collect()))) == _components(rows)


@pytest.mark.parametrize("wanted", [0, 20, 1_000_000])
def test_lists_of_any_length(spark, odd, monkeypatch, wanted):
    """Repeated rows, repeated ids, null ids, whether lists go to all tasks or not."""
    monkeypatch.setattr(nj, "WANTED", wanted)
    rows = _near_copies(seed=5)[:60]
    rows += rows[:30] + [(None, t) for _, t in rows[:3]] + [(None, "a set that only rows without an id have"), (rows[0][0], rows[7][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(repr, map(tuple, nj.ngram_join(df).collect()))) == _components(rows)


def test_many_distances_equal_those_of_one_pair():
    rnd = np.random.default_rng(3)
    sets = [rnd.integers(0, 2**63, n, dtype=np.uint64) for n in (3, 60, 300, 500, 1200, 1500, 5000)]
    sets += [np.concatenate([s[: len(s) // 2], s[: len(s) // 2] + np.uint64(1 << 45)]) for s in sets]
    sketches = [np.frombuffer(nj.sketch(s), np.uint8) for s in sets]
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    assert nj._distances(sketches, i, j).tolist() == [nj.sketch_distance(sketches[a].tobytes(), sketches[b].tobytes()) for a, b in zip(i, j, strict=True)]


def test_shingles_are_counted_over_all_documents(spark, odd):
    """Also those that few documents of each task hold."""
    common = "a line that every fourth document has"
    rows = [(i, f"{i} own words {i * 7} of document {i * 11} here " + (common if i % 4 == 0 else "")) for i in range(48)]
    df = spark.createDataFrame(rows, "id long, text string").repartition(16)
    counts = nj._common(nj._profiles(df, 5))
    (shingles,) = shingle_sets([common])
    assert (counts[nj._cell(shingles)] >= 12).all()
    assert int(counts.sum()) == sum(map(len, shingle_sets([t for _, t in rows])))


def test_shuffle_files_go_with_their_step(spark, odd):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv
    disk = env.get().blockManager().diskBlockManager()

    def files():
        blocks = disk.getAllBlocks()
        return {name for k in range(blocks.size()) if (name := blocks.apply(k).name()).startswith("shuffle_")}

    rnd = random.Random(2)
    rows = [(i, " ".join(f"w{rnd.randint(0, 50)}" for _ in range(40))) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    before = files()
    nj.ngram_join(df)
    until = time.time() + 20
    while len(files() - before) > 30 and time.time() < until:
        time.sleep(0.5)
    assert len(files() - before) <= 30


def test_most_rows_may_go_without_a_shuffle_of_texts(spark, odd, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "SHORT", 40)
    docs = spark.range(0, 1000, 1, 3).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    kept = corpus_pipeline._rows_kept(docs, lambda rows: rows.where("doc_id % 100 = 63 or doc_id < 2"))
    assert "hashpartitioning" not in kept._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, *range(63, 1000, 100)]
    assert kept.columns == docs.columns
