"""First-wins duplicates by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _check_keys(df: DataFrame, keys: list[str]) -> None:
    for key in keys:
        if key not in df.columns:
            raise KeyError(f"Deduplication key '{key}' is not a column of {df.columns}")


def dedupe_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in ``order``.

    The filter on the row number becomes a group limit on both sides of the
    shuffle: each task sends at most one row per key, so that a key held by a third
    of all rows costs one row per task.
    """
    _check_keys(df, keys)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def count_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row, ``duplicate_count``: rows beyond the first of their key."""
    _check_keys(df, keys)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias("duplicate_count"))
