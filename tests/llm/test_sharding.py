"""Shards of near equal bytes, whole groups and gapless slots."""

import zlib

from pyspark.sql import functions as F

from gaugeworks.llm import sharding
from tests.llm.conftest import ROWS, WORD_BPE


def _check(found, shards, rows):
    assert len(found) == rows
    for _, own in found.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))
    assert found["shard"].between(0, shards - 1).all()


def test_odd_rows(odd, empty):
    measured = sharding.measured(odd, WORD_BPE)
    found = sharding.shard_rows(measured, 4).toPandas()
    _check(found, 4, len(ROWS))
    wanted = sorted(repr((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))) for i, t in ROWS)
    assert sorted(repr((None if i != i else int(i), s, c)) for i, s, c in zip(found["doc_id"], found["size"], found["text_crc32"], strict=True)) == wanted
    assert sharding.shard_rows(sharding.measured(empty, WORD_BPE), 4).count() == 0


def test_balance_with_a_hot_group(spark):
    n = 6000
    text = F.when(F.col("doc_id") % 3 == 0, F.lit("a copy that a third of all rows share")).otherwise(
        F.concat(F.lit("row "), F.col("doc_id"), F.repeat(F.lit(" word"), F.pmod(F.xxhash64("doc_id"), F.lit(60)).cast("int")))
    )
    df = spark.range(n).withColumnRenamed("id", "doc_id").withColumn("text", text)
    found = sharding.shard_rows(sharding.measured(df, WORD_BPE), 8, bucket_rows=1500).toPandas()
    _check(found, 8, n)
    sums = found.groupby("shard").agg(size=("size", "sum"), tokens=("tokens", "sum"), rows=("size", "count"))
    assert sums["size"].max() - sums["size"].min() < 0.01 * sums["size"].mean()
    assert sums["tokens"].max() - sums["tokens"].min() < 0.05 * sums["tokens"].mean()
    assert sums["rows"].max() - sums["rows"].min() < 0.25 * sums["rows"].mean()


def test_small_groups_stay_whole(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "concat('text of group ', cast(id % 1000 as string), ' with some words') as text")
    found = sharding.shard_rows(sharding.measured(df, WORD_BPE), 5).toPandas()
    assert (found.groupby(found["doc_id"] % 1000)["shard"].nunique() == 1).all()


def _grouped(spark, sizes):
    """Rows (id, size, tokens, crc, key) of groups of so many rows each."""
    rows = [(i, 100, 10, 1, f"g{g}") for g, n in enumerate(sizes) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, size long, tokens long, text_crc32 long, key string")


def _pieces(spark, sizes, shards):
    """Shards over which each group is spread, and rows per shard."""
    rows = _grouped(spark, sizes).withColumnRenamed("doc_id", "at").withColumn("doc_id", F.concat_ws("/", "key", "at")).drop("at")
    found = sharding.shard_rows(rows, shards, bucket_rows=300).toPandas()
    _check(found, shards, sum(sizes))
    found["group"] = found["doc_id"].str.split("/").str[0]
    return found.groupby("group")["shard"].nunique().to_dict(), found.groupby("shard").size()


def test_a_group_that_just_fits_a_shard_stays_whole(spark):
    """Ten shards of 300 rows: groups of 300, 299, 150 and 31 rows fit one, no shard can hold a group of 301."""
    sizes = [300, 299, 150, 31, 301, *[3] * 600, *[1] * 119]
    pieces, loads = _pieces(spark, sizes, 10)
    assert pieces.pop("g4") > 1 and set(pieces.values()) == {1}
    assert loads.max() <= 315 and loads.min() >= 285


def test_a_third_of_all_rows_is_spread_evenly(spark):
    pieces, loads = _pieces(spark, [1000, *[2] * 1000], 6)
    assert pieces.pop("g0") == 6 and set(pieces.values()) == {1}
    assert loads.max() - loads.min() <= 20


def test_null_ids_and_one_text_for_all(spark):
    df = spark.createDataFrame([(None, "same")] * 50, "doc_id long, text string")
    found = sharding.shard_rows(sharding.measured(df, WORD_BPE), 4).toPandas()
    _check(found, 4, 50)
