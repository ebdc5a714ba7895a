"""Mergeable profiles of a column: moments and a quantile sketch per group.

A profile is a row of a few numbers and a sketch. Profiles of different rows merge into the
profile of all of them, so statistics over many loads are kept up by profiling the new rows
alone. Moments are central ones, merged by the distances of the means, so large offsets cost
no digits; quantiles come from a KLL sketch and are approximate, with a rank error that
follows from its size and not from the values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Size of a sketch. Quantiles of one, or of any merged from such, are off by about 0.3 % of
# the rows; a sketch takes up to 17 KB, and no more than the values it has seen.
SKETCH_SIZE = 1_000
RANK_ERROR = 0.01
# Even quantiles that a box is read from.
STEPS = 1_000


def _number(column: str) -> Column:
    """The column as a double, NaN as NULL."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def _moments(v: Column) -> tuple[Column, Column]:
    """Mean and summed squared distance from it, without rounding where all values are equal."""
    constant = F.min(v) == F.max(v)
    return F.when(constant, F.min(v)).otherwise(F.avg(v)), F.when(constant, 0.0).otherwise(F.var_pop(v) * F.count(v))


def profile(df: DataFrame, keys: list[str], value: str, other: str | None = None, sketch_size: int = SKETCH_SIZE) -> DataFrame:
    """One row per group: ``n``, ``mean``, ``m2`` (summed squared distance from the mean), ``low``, ``high``, ``sketch``.

    Rows whose value is NULL or NaN are left out. With ``other`` rows need both, and
    ``other_mean``, ``other_m2`` and ``co_moment`` are added.
    """
    rows = df.select(*keys, _number(value).alias("_v"), *([_number(other).alias("_o")] if other else []))
    rows = rows.dropna(subset=["_v", "_o"] if other else ["_v"])
    n, v = F.count(F.lit(1)), F.col("_v")
    mean, m2 = _moments(v)
    aggregates = [
        n.alias("n"), mean.alias("mean"), m2.alias("m2"), F.min(v).alias("low"), F.max(v).alias("high"),
        F.kll_sketch_agg_double(v, F.lit(sketch_size)).alias("sketch"),
    ]
    if other:
        mean, m2 = _moments(F.col("_o"))
        aggregates += [mean.alias("other_mean"), m2.alias("other_m2"), (F.covar_pop("_v", "_o") * n).alias("co_moment")]
    return rows.groupBy(*keys).agg(*aggregates)


def merge_profiles(profiles: DataFrame, keys: list[str]) -> DataFrame:
    """Profiles with equal ``keys`` (at least one) merged; their other columns go.

    One of the means of a group is its origin. Around it the moments of the parts simply
    add up: two aggregates with a map-side part, however many profiles a group has.
    """
    if not keys:
        raise ValueError("profiles merge by at least one key")
    paired = "co_moment" in profiles.columns
    firsts = [F.min_by("mean", F.col("mean")).alias("_mean")] + ([F.min_by("other_mean", F.col("mean")).alias("_other")] if paired else [])
    origins = profiles.groupBy(*keys).agg(*firsts).withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [profiles[k].eqNullSafe(origins[f"_{k}"]) for k in keys]
    rows = profiles.join(origins, same)
    n, d = F.col("n"), F.col("mean") - F.col("_mean")
    sums = [
        F.sum(n).alias("n"), F.first("_mean").alias("_mean"), F.sum(n * d).alias("_d"), F.sum(F.col("m2") + n * d * d).alias("_dd"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.kll_merge_agg_double("sketch").alias("sketch"),
    ]
    if paired:
        e = F.col("other_mean") - F.col("_other")
        sums += [
            F.first("_other").alias("_other"), F.sum(n * e).alias("_e"), F.sum(F.col("other_m2") + n * e * e).alias("_ee"),
            F.sum(F.col("co_moment") + n * d * e).alias("_de"),
            ((F.max("other_m2") == 0) & (F.min("other_mean") == F.max("other_mean"))).alias("_still"),
        ]
    rows = rows.groupBy(*keys).agg(*sums)
    constant = F.col("low") == F.col("high")
    left = lambda total, a, b: F.greatest(F.col(total) - F.col(a) * F.col(b) / n, F.lit(0.0))
    merged = [
        "n", F.when(constant, F.col("low")).otherwise(F.col("_mean") + F.col("_d") / n).alias("mean"),
        F.when(constant, 0.0).otherwise(left("_dd", "_d", "_d")).alias("m2"), "low", "high", "sketch",
    ]
    if paired:
        merged += [
            F.when(F.col("_still"), F.col("_other")).otherwise(F.col("_other") + F.col("_e") / n).alias("other_mean"),
            F.when(F.col("_still"), 0.0).otherwise(left("_ee", "_e", "_e")).alias("other_m2"),
            (F.col("_de") - F.col("_d") * F.col("_e") / n).alias("co_moment"),
        ]
    return rows.select(*keys, *merged)


def deviation() -> Column:
    """Sample standard deviation of a profile, NULL for one row."""
    return F.sqrt(F.try_divide(F.col("m2"), F.col("n") - 1))


def correlation() -> Column:
    """Pearson correlation of a paired profile; NULL when a side is constant."""
    return F.try_divide(F.col("co_moment"), F.sqrt("m2") * F.sqrt("other_m2"))


def sketch_quantiles(profiles: DataFrame, keys: list[str], probabilities: list[float]) -> DataFrame:
    """``keys``, ``probability``, ``quantile``: a value of the data whose rank is near the wanted one."""
    found = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(p)) for p in probabilities]))
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    pairs = F.arrays_zip(wanted.alias("probability"), found.alias("quantile"))
    return profiles.filter("n > 0").select(*keys, F.inline(pairs))


def sketch_boxes(profiles: DataFrame, keys: list[str]) -> DataFrame:
    """Data of a box plot from profiles: ``n``, quartiles, whiskers, outlier count, all but ``n`` approximate.

    The sketch is asked for ``STEPS`` even quantiles. A whisker ends at the outermost of
    them within 1.5 interquartile ranges of the box, and outliers are those beyond.
    """
    grid = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)]))
    quartile = lambda k: F.get("grid", F.lit(STEPS * k // 4))
    boxes = profiles.filter("n > 0").select(*keys, "n", grid.alias("grid"))
    boxes = boxes.select("*", quartile(1).alias("q1"), quartile(2).alias("median"), quartile(3).alias("q3"))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.filter("grid", lambda q: q.between(F.col("q1") - reach, F.col("q3") + reach))
    return boxes.withColumn("inside", inside).select(
        *keys, "n", "q1", "median", "q3", F.array_min("inside").alias("whisker_low"), F.array_max("inside").alias("whisker_high"),
        F.round(F.col("n") * (1 - F.size("inside") / F.lit(STEPS + 1))).cast("bigint").alias("outliers"),
    )
