"""One load: files to dimensions, facts, rejects and run log."""

from __future__ import annotations

import logging
import os
import uuid
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions.parse import parse_int
from gaugeworks.operators.dedupe import dedupe_first
from gaugeworks.operators.load import GEOGRAPHIC_MAP, INDICATOR_MAP, extract_dimension, fact_projection, new_rows
from gaugeworks.operators.mapping import inject_bad_row
from gaugeworks.operators.rejects import metric_columns, reject_rows, reject_samples, reject_summary
from gaugeworks.operators.runs import FAILED, STARTED, SUCCESS
from gaugeworks.operators.validate import REASON, rejected_rows, tag_records, valid_rows
from gaugeworks.schemas import FILE_ORDER
from gaugeworks.session import shuffle_width
from gaugeworks.sources.files import scan_source
from gaugeworks.sources.keyindex import index_width, stored_keys, write_attempt_keys
from gaugeworks.sources.spec import SourceSpec
from gaugeworks.sources.tables import append_run_event, check_run_id, read_run_events, read_table, write_run_rows

log = logging.getLogger(__name__)

FACT_KEY = "unique_id"


@dataclass(frozen=True)
class RunReport:
    run_id: str
    status: str
    total_records: int
    valid_records: int
    rejected_records: int
    inserted_records: int
    skipped_records: int


def log_reject_summary(rejected: DataFrame) -> None:
    """Log the five most common reasons and the first five rejected rows."""
    for row in reject_summary(rejected, FILE_ORDER).collect():
        log.warning("%d of %d rejected: %s", row.reject_count, row.total_rejected, row.error_reason)
    for row in reject_samples(rejected, FILE_ORDER).collect():
        log.warning("reject sample: %s", row.asDict())


def _stage(raw: DataFrame, spec: SourceSpec, path: str) -> tuple[DataFrame, dict]:
    """Write the tagged rows once, with their counts and key range taken on the way.

    Four writers read the staged table with only the columns they need, so the
    source is parsed once and its file order is fixed as data.
    """
    key = parse_int(F.col(FACT_KEY), spec.rules.lenient_int)
    key = F.when(F.col(REASON).isNull(), key)
    seen = Observation()
    tagged = tag_records(raw, spec.rules, spec.null_tokens).observe(
        seen, *metric_columns(), F.min(key).alias("least_key"), F.max(key).alias("greatest_key")
    )
    tagged.write.mode("overwrite").parquet(path)
    return raw.sparkSession.read.schema(tagged.schema).parquet(path), seen.get


def _load(staged: DataFrame, counts: dict, spec: SourceSpec, warehouse: str, run_id: str, attempt: str, buckets: int) -> int:
    """Dimensions, then facts and their keys, then rejects; returns the number of new facts."""
    spark = staged.sparkSession
    valid = valid_rows(staged, spec.rules)
    for table, mapping, key in (
        ("indicators", INDICATOR_MAP, "indicator_id"),
        ("geographic", GEOGRAPHIC_MAP, "geo_join_id"),
    ):
        found = extract_dimension(valid, mapping, key, FILE_ORDER)
        known = read_table(spark, warehouse, table).select(key)
        write_run_rows(found.join(known, key, "left_anti"), warehouse, table, run_id, attempt)

    # First wins on the fact key alone already picks the first row of any key list
    # that holds it; other lists need their own pass.
    if spec.dedup_keys and FACT_KEY not in spec.dedup_keys:
        valid = dedupe_first(valid, spec.dedup_keys, FILE_ORDER)
    facts = fact_projection(valid, run_id, keep=FILE_ORDER)
    key_range = (counts["least_key"], counts["greatest_key"])
    written = Observation()

    def write_new(existing: DataFrame | None, indexed: DataFrame | None) -> None:
        fresh = new_rows(facts, existing, FACT_KEY, FILE_ORDER, key_range, counts["valid_records"], indexed)
        fresh = fresh.withColumn("load_timestamp", F.current_timestamp())
        write_run_rows(
            fresh.observe(written, F.count(F.lit(1)).alias("inserted")), warehouse, "measurements", run_id, attempt
        )

    if buckets:
        stored = stored_keys(spark, warehouse, buckets)
        with stored.index.as_wide(spark):
            write_new(stored.others, stored.indexed)
        write_attempt_keys(spark, warehouse, buckets, run_id, attempt)
    else:
        write_new(read_table(spark, warehouse, "measurements"), None)

    rejects = reject_rows(rejected_rows(staged), run_id, FILE_ORDER)
    write_run_rows(rejects, warehouse, "ingestion_rejects", run_id, attempt)
    return written.get["inserted"]


def stored_report(spark: SparkSession, warehouse: str, run_id: str) -> RunReport | None:
    """The report of a run that has succeeded, from the run log."""
    done = read_run_events(spark, warehouse).filter((F.col("run_id") == run_id) & (F.col("status") == SUCCESS))
    last = done.orderBy(F.desc("event_timestamp")).first()
    return RunReport(**{f.name: last[f.name] for f in fields(RunReport)}) if last else None


def run_ingest(
    spark: SparkSession,
    spec: SourceSpec,
    warehouse: str,
    run_id: str | None = None,
    force_reject: bool = False,
    source: DataFrame | None = None,
    key_buckets: int | None = None,
) -> RunReport:
    """Load one source into the warehouse folder.

    Rows become visible with the SUCCESS event, which is written last; a failed load
    leaves a FAILED event and no visible row, and the error is raised again. A failed
    run may be tried again under its id. A run that has succeeded is not loaded again:
    its stored report is the answer, so neither a replay nor a failing retry can touch
    rows that others rely on. ``source`` gives the rows directly, in the form
    :func:`scan_source` returns. One load at a time may write to a warehouse.

    ``key_buckets`` keeps the keys of the facts in an index of so many buckets, in which
    the keys of a batch are looked up without a shuffle of the stored ones. None goes on
    with the index that the warehouse has, if any; 0 neither uses nor fills it. What is
    loaded is the same in every case.
    """
    run_id = check_run_id(run_id or uuid.uuid4().hex)
    stored = stored_report(spark, warehouse, run_id)
    if stored:
        log.info("load %s has succeeded before", run_id)
        return stored
    attempt = uuid.uuid4().hex
    buckets = index_width(spark, warehouse) if key_buckets is None else key_buckets
    source_file = os.path.basename(spec.path.rstrip("/"))
    append_run_event(spark, warehouse, run_id=run_id, source_file=source_file, status=STARTED, attempt=attempt)
    totals = {"total_records": 0, "valid_records": 0, "rejected_records": 0}
    try:
        raw = scan_source(spark, spec) if source is None else source
        if force_reject:
            raw = inject_bad_row(raw, FILE_ORDER)
        staged, counts = _stage(raw, spec, f"{warehouse}/_staging/{spec.key}")
        totals = {name: counts[name] for name in totals}
        if totals["rejected_records"]:
            log_reject_summary(rejected_rows(staged))
        with shuffle_width(spark, totals["total_records"]):
            inserted = _load(staged, counts, spec, warehouse, run_id, attempt, buckets)
    except Exception as error:
        append_run_event(
            spark,
            warehouse,
            run_id=run_id,
            source_file=source_file,
            status=FAILED,
            error_message=str(error),
            attempt=attempt,
            **{**totals, "valid_records": 0, "inserted_records": 0, "skipped_records": 0},
        )
        log.exception("load %s failed", run_id)
        raise
    report = RunReport(
        run_id=run_id,
        status=SUCCESS,
        inserted_records=inserted,
        skipped_records=totals["valid_records"] - inserted,
        **totals,
    )
    append_run_event(spark, warehouse, source_file=source_file, attempt=attempt, key_buckets=buckets, **vars(report))
    return report
