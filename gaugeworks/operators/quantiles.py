"""Exact quantiles per group without gathering a group.

Each wanted quantile lies between two order statistics. The range that holds them is
narrowed by counting: rows inside the current range are counted into cells, which needs one map-side aggregate and a shuffle of counts only, and the cell
that holds the wanted rank is the next range. When few rows are left inside every
range, their distinct values are ranked. The result equals linear interpolation on
the sorted values, whatever the distribution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.session import settle

CELLS = 4096
RANK_LIMIT = 500_000
_LARGEST = 1.7976931348623157e308


def _targets(rows: DataFrame, probabilities: list[float]) -> DataFrame:
    """One row per group and probability: the two ranks and the range that holds them.

    ``low`` and ``high`` are values of the data; ``below`` rows lie under ``low`` and
    ``inside`` rows from ``low`` to ``high``. ``open`` tells that the range still has
    to be narrowed; when closed, ``low`` and ``high`` are the two order statistics.
    """
    position = F.col("probability") * (F.col("group_count") - 1)
    return (
        rows.groupBy("g")
        .agg(F.count(F.lit(1)).alias("group_count"), F.min("v").alias("low"), F.max("v").alias("high"))
        .withColumn("probability", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
        .select(
            "g",
            "probability",
            F.floor(position).alias("rank"),
            F.least(F.floor(position) + 1, F.col("group_count") - 1).alias("next_rank"),
            (position - F.floor(position)).alias("fraction"),
            "low",
            "high",
            F.lit(0).cast("bigint").alias("below"),
            F.col("group_count").alias("inside"),
            (F.col("low") < F.col("high")).alias("open"),
        )
    )


def _inside(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows within each distinct open range of their group."""
    ranges = targets.filter("open").select("g", "low", "high").distinct()
    return rows.join(ranges, "g").filter(F.col("v").between(F.col("low"), F.col("high")))


def _scaled(value: Column) -> Column:
    """Order-preserving map of all doubles to a short range, by magnitude."""
    size = F.least(F.abs(value), F.lit(_LARGEST))
    return F.when(size > 0, F.signum(value) * (F.ln(size) + 745)).otherwise(0.0)


def _cells(rows: DataFrame, targets: DataFrame, cells: int) -> DataFrame:
    """Counts and extremes per cell of each range.

    Cells are of equal width where the range's ends are of one sign and at most a factor
    of two apart, else of equal width by magnitude, so few rounds narrow any range. A
    range too short for either is cut into its lowest value and the rest.
    """
    v, low, high = F.col("v"), F.col("low"), F.col("high")
    close = ((low > 0) & (high / 2 <= low)) | ((high < 0) & (low / 2 >= high))
    finite = (F.abs(low) <= _LARGEST) & (F.abs(high) <= _LARGEST)
    linear = F.try_divide(v - low, high - low)
    by_size = F.try_divide(_scaled(v) - _scaled(low), _scaled(high) - _scaled(low))
    share = F.when(close & finite, linear).otherwise(by_size)
    # least() skips NULL, so a missing share has to be asked for.
    placed = F.least(F.floor(share * cells), F.lit(cells - 1))
    cell = F.when(share.isNotNull(), placed).otherwise(F.when(v > low, F.lit(1)).otherwise(0)).cast("bigint")
    return (
        _inside(rows, targets)
        .groupBy("g", "low", "high", cell.alias("cell"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("cell_low"), F.max("v").alias("cell_high"))
    )


def _values(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Counts per distinct value of each range."""
    counted = _inside(rows, targets).groupBy("g", "low", "high", "v").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumns({"cell_low": F.col("v"), "cell_high": F.col("v")})


def _narrow(targets: DataFrame, cells: DataFrame) -> DataFrame:
    """Replace each open range by the cell that holds its rank.

    When the two ranks lie in neighbouring cells, they are the greatest value of one
    and the least of the other, and the range is closed.
    """
    upto = Window.partitionBy("g", "low", "high").orderBy("cell_low").rowsBetween(Window.unboundedPreceding, 0)
    running = cells.withColumn("upto", F.sum("n").over(upto)).withColumn("before", F.col("upto") - F.col("n"))
    opened, closed = targets.filter("open"), targets.filter("NOT open")

    def holds(rank: str):
        offset = F.col(rank) - F.col("below")
        return (F.col("before") <= offset) & (offset < F.col("upto"))

    ranked = opened.join(running, ["g", "low", "high"]).groupBy(
        "g", "probability", "rank", "next_rank", "fraction", "below"
    )
    picked = ranked.agg(
        F.max(F.when(holds("rank"), F.struct("before", "n", "cell_low", "cell_high"))).alias("here"),
        F.max(F.when(holds("next_rank"), F.struct("before", "cell_low"))).alias("there"),
    )
    same = F.col("here.before") == F.col("there.before")
    narrowed = picked.select(
        "g",
        "probability",
        "rank",
        "next_rank",
        "fraction",
        F.when(same, F.col("here.cell_low")).otherwise(F.col("here.cell_high")).alias("low"),
        F.when(same, F.col("here.cell_high")).otherwise(F.col("there.cell_low")).alias("high"),
        (F.col("below") + F.col("here.before")).alias("below"),
        F.col("here.n").alias("inside"),
        (same & (F.col("here.cell_low") < F.col("here.cell_high"))).alias("open"),
    )
    return closed.unionByName(narrowed)


def group_quantiles(
    df: DataFrame,
    group: str,
    value: str,
    probabilities: list[float],
    cells: int = CELLS,
    rank_limit: int = RANK_LIMIT,
) -> DataFrame:
    """Columns ``group``, ``probability``, ``quantile``; NULL and NaN are left out.

    ``rank_limit`` bounds the rows ranked at once. The narrow pair of group and value is
    written once; each round of narrowing reads it.
    """
    number = F.col(value).cast("double")
    rows = df.select(F.col(group).alias("g"), number.alias("v")).filter(
        F.col("g").isNotNull() & F.col("v").isNotNull() & ~F.isnan("v")
    )
    rows = settle(rows, "quantile-rows")
    targets = settle(_targets(rows, probabilities), "quantile-ranges")
    while True:
        most = targets.filter("open").agg(F.max("inside")).first()[0]
        if most is None:
            break
        if most <= rank_limit:
            targets = settle(_narrow(targets, _values(rows, targets)), "quantile-ranges")
            break
        targets = settle(_narrow(targets, _cells(rows, targets, cells)), "quantile-ranges")
    between = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(
        F.col("low") + F.col("fraction") * (F.col("high") - F.col("low"))
    )
    return targets.select(F.col("g").alias(group), "probability", between.alias("quantile"))


def box_summary(df: DataFrame, group: str = "season_idx", value: str = "data_value", **limits: int) -> DataFrame:
    """Data of a box plot per group: count, quartiles, whiskers, outlier count.

    A whisker ends at the outermost value within 1.5 interquartile ranges of the box.
    """
    quartiles = group_quantiles(df, group, value, [0.25, 0.5, 0.75], **limits)

    def quartile(probability: float):
        return F.max(F.when(F.col("probability") == probability, F.col("quantile")))

    boxes = quartiles.groupBy(group).agg(
        quartile(0.25).alias("q1"), quartile(0.5).alias("median"), quartile(0.75).alias("q3")
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    number = F.col(value).cast("double")
    near = number.between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        df.filter(number.isNotNull() & ~F.isnan(number))
        .select(group, value)
        .join(boxes, group)
        .groupBy(group, "q1", "median", "q3")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.least(F.min(F.when(near, number)), F.col("q1")).alias("whisker_low"),
            F.greatest(F.max(F.when(near, number)), F.col("q3")).alias("whisker_high"),
            F.count_if(~near).alias("outliers"),
        )
    )
