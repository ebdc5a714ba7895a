"""Dimensions, facts and keyed appends."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.operators.dedupe import dedupe_first
from gaugeworks.operators.mapping import map_columns

# Dimension column to source column.
INDICATOR_MAP = {c: c for c in ("indicator_id", "name", "measure", "measure_info")}
GEOGRAPHIC_MAP = {c: c for c in ("geo_join_id", "geo_type_name", "geo_place_name")}
# Rows of a batch up to which its keys, integers, are sent to all tasks.
FEW_ROWS = 1_000_000
FACT_COLUMNS = [
    "unique_id",
    "indicator_id",
    "geo_join_id",
    "time_period",
    "start_date",
    "data_value",
    "message",
]


def extract_dimension(df: DataFrame, mapping: Mapping[str, str], key: str, order: list[str]) -> DataFrame:
    """First row per dimension id; ``mapping`` is target column to source column.

    Only the mapped columns are scanned and each task sends one row per id.
    """
    columns = {source: target for target, source in mapping.items()}
    named = map_columns(df, columns, keep=order).filter(F.col(key).isNotNull())
    return dedupe_first(named, [key], order).select(*mapping)


def fact_projection(df: DataFrame, run_id: str, keep: list[str] | None = None) -> DataFrame:
    """Fact columns of the rows with a key, with their run."""
    facts = map_columns(df, {c: c for c in FACT_COLUMNS}, keep=keep)
    return facts.filter(F.col("unique_id").isNotNull()).withColumn("run_id", F.lit(run_id))


def new_rows(
    batch: DataFrame,
    existing: DataFrame | None,
    key: str,
    order: list[str],
    key_range: tuple[object, object] | None = None,
    batch_rows: int | None = None,
    indexed: DataFrame | None = None,
) -> DataFrame:
    """First row per key of the batch whose key is neither in ``existing`` nor in ``indexed``.

    Only the key column of ``existing`` is read. ``key_range``, the least and
    greatest key of the batch when the caller knows them, lets the scan skip row
    groups. Of a batch of at most ``FEW_ROWS`` rows the keys go to all tasks, so that
    of the stored keys only those that the batch has are shuffled, however many are
    stored; a larger batch is joined with all in its range. Window and anti-join share
    one shuffle of the batch on the key.

    ``indexed`` are keys read from a :class:`~gaugeworks.sources.keyindex.KeyIndex`. They
    are not shuffled, however large the batch is, when the action runs inside the index's
    ``as_wide``: the batch is then dealt out by the buckets they lie in.
    """
    first = dedupe_first(batch, [key], order)

    def near(stored: DataFrame) -> DataFrame:
        inside = key_range is not None and None not in key_range
        return stored.select(key).filter(F.col(key).between(*key_range)) if inside else stored.select(key)

    if indexed is not None:
        first = first.join(near(indexed), key, "left_anti")
    if existing is None:
        return first.drop(*order)
    taken = near(existing)
    if batch_rows is not None and batch_rows <= FEW_ROWS:
        taken = taken.join(F.broadcast(batch.select(key).distinct()), key, "left_semi")
    return first.join(taken, key, "left_anti").drop(*order)
