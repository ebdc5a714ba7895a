"""Joins of the fact to its dimensions.

No join carries a broadcast hint: the dimensions are files of known size, so the
optimizer broadcasts one below its threshold and otherwise shuffles, splitting
skewed partitions at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_geographic(fact: DataFrame, geographic: DataFrame) -> DataFrame:
    """Every fact row with its place name, NULL where the place is unknown."""
    return fact.join(geographic.select("geo_join_id", "geo_place_name"), "geo_join_id", "left")


def join_indicators(fact: DataFrame, indicators: DataFrame) -> DataFrame:
    """Fact rows with a known indicator, with its name; fact columns come first."""
    names = indicators.select("indicator_id", "name")
    return fact.join(names, "indicator_id").select(*[fact[c] for c in fact.columns], "name")


def for_indicator(fact: DataFrame, indicator: object) -> DataFrame:
    return fact.filter(F.col("indicator_id") == indicator)
