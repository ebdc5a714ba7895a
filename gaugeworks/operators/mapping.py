"""Projections and appended rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normalize_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def map_columns(df: DataFrame, mapping: Mapping[str, str], keep: list[str] | None = None) -> DataFrame:
    """Select source columns under their target names; an absent one is a NULL text."""
    present = set(df.columns)
    mapped = [
        (F.col(f"`{source}`") if source in present else F.lit(None).cast("string")).alias(target)
        for source, target in mapping.items()
    ]
    return df.select(*mapped, *(keep or []))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types; an absent one is NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def inject_bad_row(df: DataFrame, order: list[str], field: str = "name") -> DataFrame:
    """Append a copy of the first row with one field set to NULL."""
    first = df.orderBy(*order).limit(1)
    return df.unionByName(first.withColumn(field, F.lit(None).cast(df.schema[field].dataType)))
