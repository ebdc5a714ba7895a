"""Schemas of the wide source file and of the five warehouse tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Columns of the wide source file.
SOURCE_COLUMNS = [
    "unique_id",
    "indicator_id",
    "name",
    "measure",
    "measure_info",
    "geo_type_name",
    "geo_join_id",
    "geo_place_name",
    "time_period",
    "start_date",
    "data_value",
    "message",
]

# Where a row came from; sorting by these columns gives the file order.
FILE, BLOCK, ROW, FILE_NAME = "_file", "_block", "_row", "_file_name"
FILE_ORDER = [FILE, BLOCK, ROW]
LINEAGE = [*FILE_ORDER, FILE_NAME]
# The first surplus field of a row, or a record that cannot be read.
MALFORMED = "_extra"


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_int, _text, _time = T.IntegerType(), T.StringType(), T.TimestampType()

INDICATORS = _schema(indicator_id=_int, name=_text, measure=_text, measure_info=_text)
GEOGRAPHIC = _schema(geo_join_id=_int, geo_type_name=_text, geo_place_name=_text)
MEASUREMENTS = _schema(
    unique_id=_int,
    indicator_id=_int,
    geo_join_id=_int,
    time_period=_text,
    start_date=T.DateType(),
    data_value=T.DoubleType(),
    message=_text,
    run_id=_text,
    load_timestamp=_time,
)
INGESTION_REJECTS = _schema(
    reject_id=_text,
    run_id=_text,
    raw_record=_text,
    error_reason=_text,
    source_file=_text,
    rejected_at=_time,
)

_long = T.LongType()
RUN_EVENTS = _schema(
    run_id=_text,
    source_file=_text,
    event_timestamp=_time,
    status=_text,
    total_records=_long,
    valid_records=_long,
    rejected_records=_long,
    inserted_records=_long,
    skipped_records=_long,
    error_message=_text,
    attempt=_text,
    key_buckets=_int,
)
INGESTION_RUNS = _schema(
    run_id=_text,
    source_file=_text,
    start_timestamp=_time,
    end_timestamp=_time,
    total_records=_long,
    valid_records=_long,
    rejected_records=_long,
    inserted_records=_long,
    skipped_records=_long,
    status=_text,
    error_message=_text,
)

# Tables stored with one folder per run.
RUN_TABLES = {
    "indicators": INDICATORS,
    "geographic": GEOGRAPHIC,
    "measurements": MEASUREMENTS,
    "ingestion_rejects": INGESTION_REJECTS,
}

# Primary keys and foreign keys of the star schema.
PRIMARY_KEYS = {
    "ingestion_runs": "run_id",
    "indicators": "indicator_id",
    "geographic": "geo_join_id",
    "measurements": "unique_id",
    "ingestion_rejects": "reject_id",
}
FOREIGN_KEYS = [
    ("measurements", "indicator_id", "indicators", "indicator_id"),
    ("measurements", "geo_join_id", "geographic", "geo_join_id"),
    ("measurements", "run_id", "ingestion_runs", "run_id"),
    ("ingestion_rejects", "run_id", "ingestion_runs", "run_id"),
]
NOT_NULL = {"ingestion_rejects": ["raw_record", "error_reason", "source_file"]}
