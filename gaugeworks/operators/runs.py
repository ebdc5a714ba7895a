"""Run log: one event per change of state, the latest event is the state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STARTED, SUCCESS, FAILED = "STARTED", "SUCCESS", "FAILED"


def latest_runs(events: DataFrame) -> DataFrame:
    """One row per run: when its current attempt started, its last event and counts.

    Both picks are aggregates with a map-side part, so a run with very many events
    is not gathered in one task. At equal times the end event comes last.
    """
    at = F.struct(F.col("event_timestamp"), (F.col("status") != STARTED).alias("ended"))
    started = F.when(F.col("status") == STARTED, F.col("event_timestamp"))
    state = F.struct(
        "source_file",
        "event_timestamp",
        "status",
        "total_records",
        "valid_records",
        "rejected_records",
        "inserted_records",
        "skipped_records",
        "error_message",
    )
    latest = events.groupBy("run_id").agg(F.max(started).alias("start_timestamp"), F.max_by(state, at).alias("last"))
    ended = F.when(F.col("last.status") != STARTED, F.col("last.event_timestamp"))
    return latest.select(
        "run_id",
        "last.source_file",
        "start_timestamp",
        ended.alias("end_timestamp"),
        "last.total_records",
        "last.valid_records",
        "last.rejected_records",
        "last.inserted_records",
        "last.skipped_records",
        "last.status",
        "last.error_message",
    )


def visible_attempts(events: DataFrame) -> DataFrame:
    """Run and attempt of each run's latest success, whatever happened to the run later, and the buckets of its keys."""
    done = events.filter(F.col("status") == SUCCESS)
    latest = done.groupBy("run_id").agg(F.max_by(F.struct("attempt", "key_buckets"), "event_timestamp").alias("last"))
    return latest.select("run_id", "last.attempt", "last.key_buckets")
