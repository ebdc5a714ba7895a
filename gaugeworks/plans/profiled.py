"""The statistics of the analysis from stored profiles, so that only new loads are read.

Per load there is one profile of the measured values for each indicator, place and season.
:func:`update_profiles` reads the loads that have none yet, and no others; means,
correlation, spread and box data of any indicator then come from profiles alone, a table
that grows with loads times places and not with rows.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions.calendar import add_season
from gaugeworks.operators import profiles
from gaugeworks.operators.joins import for_indicator
from gaugeworks.operators.runs import visible_attempts
from gaugeworks.operators.stats import top_of_profile
from gaugeworks.plans.analysis import INDICATOR, PLACE, VALUE
from gaugeworks.schemas import RUN_TABLES
from gaugeworks.sources.tables import attempt_folder, path_exists, read_run_events, read_table

TABLE = "measurements"
KEYS = ["indicator_id", "geo_join_id", "season_idx"]
_STORED = (
    "attempt string, indicator_id int, geo_join_id int, season_idx int, n bigint, mean double, m2 double, low double, high double, sketch binary"
)
_DONE = "batch string, attempts array<string>"


@dataclass(frozen=True)
class Profiled:
    """Results from profiles. Means, correlation and spread are exact; boxes are approximate."""

    season_correlation: DataFrame
    season_boxes: DataFrame
    place_profile: DataFrame
    top_places: DataFrame


def _root(warehouse: str) -> str:
    return f"{warehouse}/{TABLE}_profiles"


def _done(spark: SparkSession, warehouse: str) -> list:
    path = f"{_root(warehouse)}/_done"
    return spark.read.schema(_DONE).parquet(path).collect() if path_exists(spark, path) else []


def missing_loads(spark: SparkSession, warehouse: str) -> list[tuple[str, str]]:
    """Run and attempt of the loads without profiles."""
    known = {a for row in _done(spark, warehouse) for a in row.attempts}
    visible = visible_attempts(read_run_events(spark, warehouse)).collect()
    return sorted((r.run_id, r.attempt) for r in visible if r.attempt not in known)


def update_profiles(spark: SparkSession, warehouse: str) -> int:
    """Profile the loads that have no profiles yet; returns how many. One update at a time may run.

    A batch counts once its entry in ``_done`` is written, which is last.
    """
    new = missing_loads(spark, warehouse)
    if not new:
        return 0
    folders = [attempt_folder(warehouse, TABLE, run, attempt) for run, attempt in new]
    others = [f for f in RUN_TABLES[TABLE].fields if f.name != "run_id"]
    schema = type(RUN_TABLES[TABLE])(others).add("run_id", "string").add("attempt", "string")
    facts = add_season(spark.read.schema(schema).option("basePath", f"{warehouse}/{TABLE}").parquet(*folders))
    batch = uuid.uuid4().hex
    profiles.profile(facts, ["attempt", *KEYS], VALUE).write.parquet(f"{_root(warehouse)}/batch={batch}")
    done = spark.createDataFrame([(batch, [attempt for _, attempt in new])], _DONE)
    done.coalesce(1).write.mode("append").parquet(f"{_root(warehouse)}/_done")
    return len(new)


def stored_profiles(spark: SparkSession, warehouse: str) -> DataFrame:
    """All profiles, by load and ``KEYS``."""
    paths = [f"{_root(warehouse)}/batch={row.batch}" for row in _done(spark, warehouse)]
    return spark.read.schema(_STORED).parquet(*paths) if paths else spark.createDataFrame([], _STORED)


def run_profiled(spark: SparkSession, warehouse: str, indicator: int = INDICATOR) -> Profiled:
    """The statistics of one indicator over all loads, after bringing the profiles up to date."""
    update_profiles(spark, warehouse)
    stored = for_indicator(stored_profiles(spark, warehouse), indicator).filter(F.col("season_idx").isNotNull())
    # Within a profile the season is constant, so all its co-movement is between profiles.
    still = F.lit(0.0)
    paired = stored.withColumns({"other_mean": F.col("season_idx").cast("double"), "other_m2": still, "co_moment": still})
    whole = profiles.merge_profiles(paired, ["indicator_id"])
    names = read_table(spark, warehouse, "geographic").select("geo_join_id", PLACE).filter(F.col(PLACE).isNotNull())
    places = profiles.merge_profiles(stored.join(names, "geo_join_id"), [PLACE])
    place_profile = places.select(
        PLACE, F.col("mean").alias("group_mean"), F.col("low").alias("group_min"), F.col("high").alias("group_max"),
        F.col("n").alias("group_count"), (F.col("m2") / F.col("n")).alias("group_variance"),
    )
    return Profiled(
        season_correlation=whole.select(profiles.correlation().alias("correlation")),
        season_boxes=profiles.sketch_boxes(profiles.merge_profiles(stored, ["season_idx"]), ["season_idx"]),
        place_profile=place_profile,
        top_places=top_of_profile(place_profile, PLACE),
    )
