"""Reading of the input tables, and a column of bytes for every kind of id list."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rows_of(batches: Iterator[pa.RecordBatch], most_rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of few rows, so that what a task holds follows the texts of one piece."""
    for batch in batches:
        for start in range(0, batch.num_rows, most_rows):
            yield batch.slice(start, most_rows)
