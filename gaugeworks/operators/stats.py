"""Group means, top groups and correlation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_mean(df: DataFrame, group: str = "geo_place_name", value: str = "data_value") -> DataFrame:
    """Mean per group over the values that are numbers; NULL where there is none."""
    number = F.when(_usable(F.col(value)), F.col(value))
    return df.filter(F.col(group).isNotNull()).groupBy(group).agg(F.avg(number).alias("mean_value"))


def top_groups(df: DataFrame, group: str = "geo_place_name", value: str = "data_value", top: int = 10) -> DataFrame:
    """Groups with the highest mean; equal means go by name."""
    return group_mean(df, group, value).orderBy(F.desc("mean_value"), group).limit(top)


def top_of_profile(profile: DataFrame, group: str = "geo_place_name", top: int = 10) -> DataFrame:
    """The same from a group profile, which holds the means already."""
    named = profile.select(group, F.col("group_mean").alias("mean_value"))
    return named.orderBy(F.desc("mean_value"), group).limit(top)


def _usable(column: Column) -> Column:
    return column.isNotNull() & ~F.isnan(column.cast("double"))


def correlation(df: DataFrame, x: str = "season_idx", y: str = "data_value") -> DataFrame:
    """Pearson correlation over the rows where both are present, one row.

    NULL when either side is constant or fewer than two rows remain.
    """
    pairs = df.filter(_usable(F.col(x)) & _usable(F.col(y)))
    spread = F.stddev_samp(x) * F.stddev_samp(y)
    return pairs.agg(F.try_divide(F.covar_samp(x, y), spread).alias("correlation"))
