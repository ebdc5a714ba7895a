"""Rejected rows, their summary and the counts of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.operators.mapping import map_columns
from gaugeworks.operators.validate import REASON
from gaugeworks.schemas import FILE_NAME, LINEAGE

UNKNOWN_REASON = "Unknown validation error"
UNNAMED_REASON = "Validation failed"
SAMPLE_FIELDS = ["unique_id", "indicator_id", "geo_place_name", "start_date"]


def _payload(df: DataFrame, skip: set[str]) -> Column:
    """The record as JSON text, NULL fields included."""
    fields = []
    for field in df.schema.fields:
        if field.name in skip:
            continue
        value = F.col(f"`{field.name}`")
        if field.dataType.typeName() in ("double", "float"):
            value = F.when(~F.isnan(value), value)
        fields.append(value.alias(field.name))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def reject_rows(rejected: DataFrame, run_id: str, order: list[str], source_file: Column | None = None) -> DataFrame:
    """Reject records: JSON payload, reason, source file and a stable id.

    The id is a hash of run, position and payload, so that a retry of the same run
    gives the same ids without a global sequence.
    """
    payload = _payload(rejected, {REASON, *order, *LINEAGE})
    file_name = F.col(FILE_NAME) if source_file is None else source_file
    rows = rejected.select(
        payload.alias("raw_record"),
        F.coalesce(F.col(REASON), F.lit(UNKNOWN_REASON)).alias(REASON),
        file_name.alias("source_file"),
        F.concat_ws("|", *[F.col(c).cast("string") for c in order]).alias("_position"),
    )
    return rows.select(
        F.sha2(F.concat_ws("|", F.lit(run_id), "_position", "raw_record"), 256).alias("reject_id"),
        F.lit(run_id).alias("run_id"),
        "raw_record",
        REASON,
        "source_file",
        F.current_timestamp().alias("rejected_at"),
    )


def reject_summary(rejected: DataFrame, order: list[str], top: int = 5) -> DataFrame:
    """The most common reasons with their counts and the total; a tie goes to the
    reason seen first."""
    by_reason = rejected.groupBy(F.coalesce(F.col(REASON), F.lit(UNNAMED_REASON)).alias(REASON)).agg(
        F.count(F.lit(1)).alias("reject_count"), F.min(F.struct(*order)).alias("_first")
    )
    totals = by_reason.agg(F.sum("reject_count").alias("total"))
    return (
        by_reason.orderBy(F.desc("reject_count"), "_first")
        .limit(top)
        .select(REASON, "reject_count", totals.scalar().alias("total_rejected"))
    )


def reject_samples(rejected: DataFrame, order: list[str], size: int = 5) -> DataFrame:
    """The first rejected rows."""
    first = rejected.orderBy(*order).limit(size)
    return map_columns(first, {c: c for c in [REASON, *SAMPLE_FIELDS]})


def metric_columns() -> list[Column]:
    """Counts of a run over the tagged rows, in one pass."""
    return [
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col(REASON).isNull()).alias("valid_records"),
        F.count_if(F.col(REASON).isNotNull()).alias("rejected_records"),
    ]


def run_metrics(tagged: DataFrame) -> DataFrame:
    return tagged.agg(*metric_columns())
