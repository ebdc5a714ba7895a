"""Histogram and kernel density of a numeric column."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Beyond this many bandwidths the Gaussian is exactly 0 in double precision.
KERNEL_REACH = 39.0
# Nodes of the binned density in a bandwidth.
RESOLUTION = 256


@dataclass(frozen=True)
class Spread:
    """Extremes, count and sample standard deviation of a column."""

    low: float | None
    high: float | None
    count: int
    deviation: float | None


def _first(stats: DataFrame) -> Spread:
    low, high, count, deviation = stats.select("low", "high", "n", "sd").first()
    return Spread(low, high, count, deviation)


def column_spread(df: DataFrame, value: str) -> Spread:
    number = F.col(value)
    rows = df.filter(number.isNotNull() & ~F.isnan(number))
    return _first(
        rows.agg(
            F.min(number).alias("low"),
            F.max(number).alias("high"),
            F.count(number).alias("n"),
            F.stddev_samp(number).alias("sd"),
        )
    )


def deviation_spread(profile: DataFrame) -> Spread:
    """Spread of the deviations from the group means, from the group profile alone.

    The extremes are exact, since subtracting the mean keeps the order within a
    group, and the squared deviations of all groups add up. No row is read again.
    """
    squares = F.sum(F.col("group_variance") * F.col("group_count"))
    n = F.coalesce(F.sum("group_count"), F.lit(0))
    return _first(
        profile.agg(
            F.min(F.col("group_min") - F.col("group_mean")).alias("low"),
            F.max(F.col("group_max") - F.col("group_mean")).alias("high"),
            n.alias("n"),
            F.sqrt(F.try_divide(squares, n - 1)).alias("sd"),
        )
    )


def histogram(df: DataFrame, value: str, bins: int = 50, spread: Spread | None = None) -> DataFrame:
    """Counts in equal-width bins, empty bins included; the last bin is closed.

    A column of one value gets a range of width 1 around it.
    """
    spread = spread or column_spread(df, value)
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    if not spread.count:
        return grid.limit(0).select(
            "bin",
            F.lit(0.0).alias("bin_start"),
            F.lit(0.0).alias("bin_end"),
            F.lit(0).cast("bigint").alias("bin_count"),
        )
    low, high = spread.low, spread.high
    if low == high:
        low, high = low - 0.5, high + 0.5
    number = F.col(value)
    place = F.floor((number - low) / (high - low) * bins).cast("int")
    counts = (
        df.filter(number.isNotNull() & ~F.isnan(number))
        .groupBy(F.least(place, F.lit(bins - 1)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("bin_count"))
    )
    edge = F.lit((high - low) / bins)
    return grid.join(counts, "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * edge).alias("bin_start"),
        (F.lit(low) + (F.col("bin") + 1) * edge).alias("bin_end"),
        F.coalesce("bin_count", F.lit(0)).alias("bin_count"),
    )


def _gaussian(at: Column, center: Column, bandwidth: float) -> Column:
    z = (at - center) / bandwidth
    return F.exp(-0.5 * z * z)


def _binned(rows: DataFrame, low: float, width: float) -> DataFrame:
    """Nodes ``at`` of an even grid and their ``weight``: each row's weight of 1 is shared
    between the two nodes around it, the nearer one getting more.

    The only pass over the rows is one aggregate by cell; a cell's two nodes follow from
    its count and the summed distance from its lower end. Only cells with rows exist.
    """
    place = (F.col("v") - low) / width
    cells = rows.groupBy(F.floor(place).alias("cell")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(place - F.floor(place)).alias("upper")
    )
    node = lambda cell, weight: F.struct((F.lit(low) + cell * width).alias("at"), weight.alias("weight"))
    ends = F.array(node(F.col("cell"), F.col("n") - F.col("upper")), node(F.col("cell") + 1, F.col("upper")))
    return cells.select(F.inline(ends))


def kernel_density(
    df: DataFrame,
    value: str,
    points: int = 200,
    bins: int = 50,
    spread: Spread | None = None,
    resolution: int | None = RESOLUTION,
) -> DataFrame:
    """Gaussian density on an even grid, scaled to the counts of ``bins`` bins.

    The bandwidth is Scott's: deviation times n to the power -1/5. Rows are binned onto a
    grid of ``resolution`` nodes a bandwidth and the weights of the nodes are convolved
    with the kernel, so the rows are read by one aggregate and what follows depends on the
    range, not on their number. Linear interpolation of the kernel between two nodes is off
    by at most 1 / (8 resolution^2) of its peak, about 2e-6 as set, so that is the
    bound of the error in units of the density of as many rows on one spot.

    Without ``resolution`` every row adds to the points where its kernel is not exactly 0:
    exact, but a row is multiplied by the number of those points. NULL with less than two
    rows or no spread.
    """
    spread = spread or column_spread(df, value)
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("point"))
    if spread.count < 2 or not spread.deviation:
        empty = F.lit(None).cast("double")
        return grid.select("point", F.lit(spread.low).cast("double").alias("x"), empty.alias("density"))
    low, high, n = spread.low, spread.high, spread.count
    bandwidth = spread.deviation * n ** (-0.2)
    step = (high - low) / (points - 1)
    reach = KERNEL_REACH * bandwidth
    number = F.col(value)
    rows = df.filter(number.isNotNull() & ~F.isnan(number)).select(number.cast("double").alias("v"))
    if resolution is None:
        weighted = rows.select(F.col("v").alias("at"), F.lit(1.0).alias("weight"))
    else:
        weighted = _binned(rows, low, bandwidth / resolution)
    at = F.col("at")
    first = F.greatest(F.ceil((at - reach - low) / step), F.lit(0)).cast("int")
    last = F.least(F.floor((at + reach - low) / step), F.lit(points - 1)).cast("int")
    x = F.lit(low) + F.col("point") * F.lit(step)
    sums = (
        weighted.select("at", "weight", F.explode(F.sequence(first, last)).alias("point"))
        .groupBy("point")
        .agg(F.sum(F.col("weight") * _gaussian(x, at, bandwidth)).alias("weight"))
    )
    # count * bin width * 1 / (count * bandwidth * sqrt(2 pi))
    scale = (high - low) / bins / (bandwidth * math.sqrt(2 * math.pi))
    return grid.join(sums, "point", "left").select(
        "point", x.alias("x"), (F.coalesce("weight", F.lit(0.0)) * scale).alias("density")
    )
