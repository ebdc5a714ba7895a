"""The analysis of one indicator and the two exports, from the warehouse tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions.calendar import add_season, split_date
from gaugeworks.operators.distribution import deviation_spread, histogram, kernel_density
from gaugeworks.operators.features import category_index, category_names, group_deviation, group_profile, one_hot, one_hot_sparse
from gaugeworks.operators.joins import for_indicator, join_geographic, join_indicators
from gaugeworks.operators.quantiles import box_summary
from gaugeworks.operators.stats import correlation, top_of_profile
from gaugeworks.session import settle
from gaugeworks.sources.files import write_csv
from gaugeworks.sources.tables import read_table

PLACE, VALUE, DEVIATION = "geo_place_name", "data_value", "pollution_deviation"
# Fixed value: the indicator the analysis looks at unless told otherwise.
INDICATOR = 365


@dataclass(frozen=True)
class Analysis:
    season_correlation: DataFrame
    season_boxes: DataFrame
    deviations: DataFrame
    top_places: DataFrame
    deviation_histogram: DataFrame
    deviation_density: DataFrame
    encoded: DataFrame
    split: DataFrame


def place_rows(fact: DataFrame, geographic: DataFrame, indicator: int) -> DataFrame:
    """Rows of one indicator with date, value and place name all present."""
    columns = ["unique_id", "indicator_id", "geo_join_id", PLACE, "start_date", VALUE]
    joined = join_geographic(for_indicator(fact, indicator), geographic).select(*columns)
    return joined.dropna(subset=["start_date", VALUE, PLACE])


def _names_in_use(fact: DataFrame, indicators: DataFrame) -> list[str]:
    """Indicator names that facts refer to: one narrow column of the fact is read, and the names come from the dimension."""
    used = fact.select("indicator_id").distinct()
    return category_names(indicators.join(used, "indicator_id", "left_semi"))


def _encoded(fact: DataFrame, indicators: DataFrame, limit: int | None, sparse: bool) -> DataFrame:
    named = join_indicators(fact, indicators)
    if sparse:
        used = fact.select("indicator_id").distinct()
        names = indicators.join(used, "indicator_id", "left_semi")
        return one_hot_sparse(named, index=settle(category_index(names), "category-index"))
    return one_hot(named, categories=_names_in_use(fact, indicators), limit=limit)


def run_analysis(
    spark: SparkSession,
    warehouse: str,
    indicator: int = INDICATOR,
    export_to: str | None = None,
    category_limit: int | None = None,
    sparse_names: bool = False,
) -> Analysis:
    """All results as DataFrames; with ``export_to`` also the two CSV exports there.

    The rows of the indicator with their places are written once and read by the results
    that need them; the top places come from the same group profile as the deviations.
    With ``sparse_names`` the encoded rows have one sparse vector, JSON in the export, in place of a column
    per indicator name, so that no name passes through the driver.
    """
    fact = read_table(spark, warehouse, "measurements")
    geographic = read_table(spark, warehouse, "geographic")
    indicators = read_table(spark, warehouse, "indicators")

    seasonal = add_season(for_indicator(fact, indicator))
    places = settle(add_season(place_rows(fact, geographic, indicator)), "places")
    profile = group_profile(places, PLACE, VALUE)
    deviations = group_deviation(places, PLACE, VALUE, deviation=DEVIATION, profile=profile)
    spread = deviation_spread(profile)

    result = Analysis(
        season_correlation=correlation(seasonal),
        season_boxes=box_summary(seasonal),
        deviations=deviations,
        top_places=top_of_profile(profile, PLACE),
        deviation_histogram=histogram(deviations, DEVIATION, spread=spread),
        deviation_density=kernel_density(deviations, DEVIATION, spread=spread),
        encoded=_encoded(fact, indicators, category_limit, sparse_names),
        split=split_date(fact),
    )
    if export_to:
        text = result.encoded.withColumn("name_vector", F.to_json("name_vector")) if sparse_names else result.encoded
        write_csv(text, f"{export_to}/encoded_measurements.csv")
        write_csv(result.split, f"{export_to}/split_measurements.csv")
    return result
