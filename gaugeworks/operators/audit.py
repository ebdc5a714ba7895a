"""Checks of the keys and references a database would enforce.

Every check first counts per key, with a map-side part, and compares keys after
that; no key's rows are ever gathered.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def pk_violations(df: DataFrame, key: str | list[str]) -> DataFrame:
    """Keys held by more than one row, and NULL keys, with their row count."""
    keys = [key] if isinstance(key, str) else key
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    missing = F.lit(False)
    for name in keys:
        missing = missing | F.col(name).isNull()
    return counts.filter((F.col("row_count") > 1) | missing)


def fk_orphans(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Non-NULL foreign keys without a parent row, with their row count."""
    used = (
        child.filter(F.col(foreign_key).isNotNull())
        .groupBy(F.col(foreign_key).alias("key"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    known = parent.select(F.col(key).alias("key"))
    return used.join(known, "key", "left_anti").withColumnRenamed("key", foreign_key)


def not_null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULL count of each column that must not be NULL."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "null_count")


def dimension_conflicts(df: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """Ids that occur with more than one set of attributes, and how many sets."""
    variants = df.filter(F.col(key).isNotNull()).select(key, *attributes).distinct()
    counts = variants.groupBy(key).agg(F.count(F.lit(1)).alias("variant_count"))
    return counts.filter(F.col("variant_count") > 1)


# What a row says of a check: its own key, a key it refers to, a key it can be referred to by, a NULL.
_OWN, _USED, _OFFERED, _MISSING = "own", "used", "offered", "missing"


def _mark(check: int, column: T.StructField, says: str) -> Column:
    """One row's entry for a check, or NULL if it has nothing to say there. Whole numbers stay numbers."""
    value = F.col(column.name)
    number = value.cast("bigint") if isinstance(column.dataType, T.IntegralType) else F.lit(None).cast("bigint")
    text = F.lit(None).cast("string") if isinstance(column.dataType, T.IntegralType) else value.cast("string")
    entry = F.struct(F.lit(check).alias("check"), F.lit(says).alias("says"), number.alias("number"), text.alias("text"))
    if says == _OWN:
        return entry
    return F.when(value.isNull() if says == _MISSING else value.isNotNull(), entry)


def audit_tables(
    tables: Mapping[str, DataFrame],
    primary_keys: Mapping[str, str],
    foreign_keys: list[tuple[str, str, str, str]],
    not_null: Mapping[str, list[str]],
) -> DataFrame:
    """All checks at once, every table read once: ``check_kind``, ``table_name``, ``column_name``, ``violations``.

    A row says what it has to say for each check it takes part in; entries are counted per
    check and key, with a map-side part, so a key that all rows share costs one entry a
    task. A row violates a primary key if its key is NULL or another row has it, a foreign
    key (child, column, parent, key) if no parent row has its key, not being NULL.
    """
    checks = [("primary key", table, key) for table, key in primary_keys.items()]
    checks += [("foreign key", child, column) for child, column, _, _ in foreign_keys]
    checks += [("not null", table, column) for table, columns in not_null.items() for column in columns]
    entries: dict[str, list[Column]] = {table: [] for table in tables}

    def says(check: int, table: str, column: str, what: str) -> None:
        entries[table].append(_mark(check, tables[table].schema[column], what))

    for check, (kind, table, column) in enumerate(checks):
        if kind == "foreign key":
            _, _, parent, key = foreign_keys[check - len(primary_keys)]
            says(check, table, column, _USED)
            says(check, parent, key, _OFFERED)
        else:
            says(check, table, column, _OWN if kind == "primary key" else _MISSING)

    said = [df.select(F.inline(F.array_compact(F.array(*entries[table])))) for table, df in tables.items() if entries[table]]
    count = lambda what: F.count_if(F.col("says") == what).alias(what)
    keys = reduce(DataFrame.unionByName, said).groupBy("check", "number", "text").agg(*map(count, (_OWN, _USED, _OFFERED, _MISSING)))
    no_key = F.col("number").isNull() & F.col("text").isNull()
    broken = F.col(_MISSING) + F.when((F.col(_OWN) > 1) | no_key, F.col(_OWN)).otherwise(0) + F.when(F.col(_OFFERED) == 0, F.col(_USED)).otherwise(0)
    found = keys.groupBy("check").agg(F.sum(broken).cast("bigint").alias("found"))
    spark = next(iter(tables.values())).sparkSession
    names = ("check_kind", "table_name", "column_name")
    listed = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, check, strict=True)]) for check in checks])
    named = spark.range(len(checks)).select(F.col("id").cast("int").alias("check"), F.get(listed, F.col("id").cast("int")).alias("name")).select("check", "name.*")
    return named.join(found, "check", "left").select("check_kind", "table_name", "column_name", F.coalesce("found", F.lit(0)).cast("bigint").alias("violations"))
