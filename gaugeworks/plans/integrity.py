"""All key, reference and NOT NULL checks over the warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugeworks.operators.audit import audit_tables
from gaugeworks.schemas import FOREIGN_KEYS, NOT_NULL, PRIMARY_KEYS
from gaugeworks.sources.tables import read_table


def check_warehouse(spark: SparkSession, warehouse: str) -> DataFrame:
    """One row per check: ``check_kind``, ``table_name``, ``column_name`` and the number
    of rows that break it. Each table is read once."""
    tables = {name: read_table(spark, warehouse, name) for name in PRIMARY_KEYS}
    return audit_tables(tables, PRIMARY_KEYS, FOREIGN_KEYS, NOT_NULL)
