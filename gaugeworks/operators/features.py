"""Feature columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.functions.parse import parse_date, parse_number
from gaugeworks.session import settle

# monotonically_increasing_id has the partition above this bit and the place in it below.
_PLACE_BITS = 33


def coerce_and_drop(
    df: DataFrame, date: str = "start_date", value: str = "data_value", needed: str = "geo_place_name"
) -> DataFrame:
    """Date and value made typed, bad ones NULL; rows with a NULL in any of the three
    columns dropped."""
    typed = df.withColumns({date: parse_date(F.col(date)), value: parse_number(F.col(value))})
    return typed.dropna(subset=[date, value, needed])


def group_profile(df: DataFrame, group: str, value: str) -> DataFrame:
    """Mean, extremes, count and spread per group, computed once and settled.

    NULL and NaN values are left out.
    """
    number = F.col(value)
    profile = (
        df.filter(F.col(group).isNotNull() & number.isNotNull() & ~F.isnan(number.cast("double")))
        .groupBy(group)
        .agg(
            F.avg(number).alias("group_mean"),
            F.min(number).alias("group_min"),
            F.max(number).alias("group_max"),
            F.count(number).alias("group_count"),
            F.var_pop(number).alias("group_variance"),
        )
    )
    return settle(profile, "group-profile")


def group_deviation(
    df: DataFrame,
    group: str = "geo_place_name",
    value: str = "data_value",
    baseline: str = "location_avg_pollution",
    deviation: str = "pollution_deviation",
    profile: DataFrame | None = None,
) -> DataFrame:
    """Add each row's group mean and its distance from it.

    Aggregate and join back, not a window: a window would sort every row of a group
    in one task, the aggregate sends one partial mean per task and group.
    """
    profile = group_profile(df, group, value) if profile is None else profile
    means = profile.select(group, F.col("group_mean").alias(baseline))
    joined = df.join(means, group, "left").select(*[df[c] for c in df.columns], baseline)
    return joined.withColumn(deviation, F.col(value) - F.col(baseline))


def category_names(df: DataFrame, column: str = "name") -> list[str]:
    """The distinct values of a column that are to become columns."""
    return sorted(row[0] for row in df.select(column).filter(F.col(column).isNotNull()).distinct().collect())


def one_hot(
    df: DataFrame,
    column: str = "name",
    categories: list[str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Replace a column by 0/1 columns, one per category but the first.

    Categories are in code-point order. Without a list they are read from the data.
    Each becomes a column, so they pass through the driver; a caller who fears too many sets ``limit``, and more of them
    are an error, or takes :func:`one_hot_sparse`.
    """
    if categories is None:
        categories = category_names(df, column)
    if limit is not None and len(categories) > limit:
        raise ValueError(f"more than {limit} categories in {column}")
    others = [F.col(f"`{c}`") for c in df.columns if c != column]
    dummies = [
        F.when(F.col(column) == category, 1).otherwise(0).alias(f"{column}_{category}") for category in categories[1:]
    ]
    return df.select(*others, *dummies)


def category_index(df: DataFrame, column: str = "name") -> DataFrame:
    """A dictionary of the distinct values: ``column`` and its ``category_index`` from 0, in code-point order.

    Values are dealt out by range, so no task orders them all; a value's index is its
    place in its range plus the sizes of the ranges before, of which there are as many as
    tasks. NULL has no index.
    """
    names = df.select(column).filter(F.col(column).isNotNull()).distinct()
    ordered = names.repartitionByRange(column).sortWithinPartitions(column)
    placed = settle(ordered.withColumn("_at", F.monotonically_increasing_id()), "categories")
    placed = placed.withColumn("_range", F.shiftright("_at", _PLACE_BITS))
    ranges = placed.groupBy("_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    index = F.col("_at") - F.col("_first") + F.col("_before")
    return placed.join(ranges, "_range").select(column, index.alias("category_index"))


def one_hot_sparse(df: DataFrame, column: str = "name", index: DataFrame | None = None) -> DataFrame:
    """Replace a column by one sparse vector, for any number of categories.

    ``{column}_vector`` has the ``size`` of the dense form, all categories but the first,
    and ``indices`` and ``values`` of what is not 0: one 1, or none for the first
    category, NULL and values that ``index`` does not have. ``index`` is a settled
    dictionary of :func:`category_index`, made from the data when there is none; it is joined,
    never collected.
    """
    index = settle(category_index(df, column), "category-index") if index is None else index
    size = max(index.count() - 1, 0)
    found = index.select(F.col(column).alias("_category"), (F.col("category_index") - 1).cast("int").alias("_place"))
    joined = df.join(found, df[column] == found["_category"], "left")
    held = F.col("_place") >= 0
    vector = F.struct(
        F.lit(size).alias("size"),
        F.when(held, F.array("_place")).otherwise(F.array().cast("array<int>")).alias("indices"),
        F.when(held, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")).alias("values"),
    )
    others = [df[f"`{c}`"] for c in df.columns if c != column]
    return joined.select(*others, vector.alias(f"{column}_vector"))
