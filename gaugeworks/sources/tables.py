"""Warehouse tables: one folder per table, run and attempt.

No attempt touches the files of another. The SUCCESS event of a run, written last,
names the attempt whose rows count; readers open the folders so named and no others,
so no row is filtered or shuffled to decide whether it is visible.
"""

from __future__ import annotations

import re
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gaugeworks.operators.mapping import conform
from gaugeworks.operators.runs import latest_runs, visible_attempts
from gaugeworks.schemas import RUN_EVENTS, RUN_TABLES

RUN_LOG = "ingestion_runs"
_RUN_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


def check_run_id(run_id: str) -> str:
    if not _RUN_ID.fullmatch(run_id):
        raise ValueError(f"run id must be letters, digits, '.', '_' or '-': {run_id!r}")
    return run_id


def path_exists(spark: SparkSession, path: str) -> bool:
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()).exists(place)


def _stored_schema(table: str) -> T.StructType:
    others = [f for f in RUN_TABLES[table].fields if f.name != "run_id"]
    return T.StructType([*others, T.StructField("run_id", T.StringType()), T.StructField("attempt", T.StringType())])


def read_run_events(spark: SparkSession, warehouse: str) -> DataFrame:
    path = f"{warehouse}/{RUN_LOG}"
    return spark.read.schema(RUN_EVENTS).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], RUN_EVENTS)


def read_table(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    """Rows of the successful runs; an empty frame when nothing is stored yet.

    The list of folders is as long as the file listing that Spark keeps of the table.
    """
    if table == RUN_LOG:
        return latest_runs(read_run_events(spark, warehouse))
    done = visible_attempts(read_run_events(spark, warehouse)).collect()
    paths = [attempt_folder(warehouse, table, r.run_id, r.attempt) for r in done]
    if not paths:
        return spark.createDataFrame([], RUN_TABLES[table])
    rows = spark.read.schema(_stored_schema(table)).option("basePath", f"{warehouse}/{table}").parquet(*paths)
    return rows.select(*RUN_TABLES[table].names)


def attempt_folder(warehouse: str, table: str, run_id: str, attempt: str) -> str:
    return f"{warehouse}/{table}/run_id={run_id}/attempt={attempt}"


def write_run_rows(df: DataFrame, warehouse: str, table: str, run_id: str, attempt: str) -> None:
    """Write the rows of one attempt of a run."""
    rows = conform(df, RUN_TABLES[table])
    rows.drop("run_id").write.parquet(attempt_folder(warehouse, table, check_run_id(run_id), check_run_id(attempt)))


def append_run_event(spark: SparkSession, warehouse: str, **event: object) -> None:
    """Append one event row to the run log."""
    event.setdefault("event_timestamp", datetime.now(UTC))
    row = tuple(event.get(name) for name in RUN_EVENTS.names)
    spark.createDataFrame([row], RUN_EVENTS).coalesce(1).write.mode("append").parquet(f"{warehouse}/{RUN_LOG}")
