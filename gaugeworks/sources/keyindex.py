"""Keys of a stored table, bucketed by hash, so that a batch of any size meets them where they lie.

The index holds the key column alone, one folder per load attempt, each with one sorted file per bucket. Spark
reads the folders of one bucket together and knows that they are hashed as a shuffle would
hash them: an anti-join then shuffles the batch only, whatever is stored, and a range of keys
still skips row groups. The facts themselves are free to be laid out for analysis.

Buckets are told to Spark through a table of the session's catalog that is dropped again as
soon as its relation is resolved; nothing depends on the catalog afterwards, and the files
stay. The number of buckets is part of the path, so that two numbers never mix.

An attempt's keys are written before its SUCCESS event and read only after it, like the rows
they belong to. ``rebuild`` merges the keys of all loads so far into one folder, for another
number of buckets or because there are many loads, and names what it covers; as with loads,
only one may run at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from contextlib import AbstractContextManager
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.operators.runs import visible_attempts
from gaugeworks.schemas import RUN_TABLES
from gaugeworks.session import setting
from gaugeworks.sources.tables import attempt_folder, path_exists, read_run_events

TABLE, KEY = "measurements", "unique_id"


@dataclass(frozen=True)
class KeyIndex:
    """Keys ``key`` of type ``kind`` below the folder ``root``, in ``buckets`` buckets."""

    root: str
    buckets: int
    key: str = KEY
    kind: str = "int"

    @property
    def path(self) -> str:
        return f"{self.root}/by={self.buckets}"

    def write(self, keys: DataFrame, attempt: str) -> None:
        """Store the column ``key`` of ``keys``, not null, as one attempt's: one sorted file per bucket."""
        name = f"keys_{uuid.uuid4().hex}"
        rows = keys.select(F.col(self.key).cast(self.kind).alias(self.key)).repartition(self.buckets, self.key)
        writer = rows.write.format("parquet").bucketBy(self.buckets, self.key).sortBy(self.key)
        try:
            writer.option("path", f"{self.path}/attempt={attempt}").saveAsTable(name)
        finally:
            keys.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")

    def read(self, spark: SparkSession, attempts: Iterable[str]) -> DataFrame:
        """The keys of ``attempts``, with their buckets known to the planner."""
        name = f"keys_{uuid.uuid4().hex}"
        # Folders are found by listing, as for any path, not looked up in the catalog.
        with setting(spark, "spark.sql.hive.manageFilesourcePartitions", "false"):
            spark.sql(
                f"CREATE TABLE {name} (`{self.key}` {self.kind}, attempt string) USING parquet PARTITIONED BY (attempt) "
                f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
            )
            try:
                keys = spark.table(name)
            finally:
                spark.sql(f"DROP TABLE {name}")
        return keys.filter(F.col("attempt").isin(*attempts)).select(self.key)

    def as_wide(self, spark: SparkSession) -> AbstractContextManager[None]:
        """Plan shuffles as wide as the index, so that a batch is dealt out by its buckets."""
        return setting(spark, "spark.sql.shuffle.partitions", str(self.buckets))


@dataclass(frozen=True)
class StoredKeys:
    """What a load has to look up: keys in the index and keys only found in the table itself."""

    index: KeyIndex
    indexed: DataFrame | None
    others: DataFrame | None


def _root(warehouse: str) -> str:
    return f"{warehouse}/{TABLE}_keys"


def _last_rebuild(spark: SparkSession, warehouse: str) -> tuple[str, int, set[str]] | None:
    """Attempt, buckets and covered attempts of the last finished rebuild."""
    path = f"{_root(warehouse)}/_rebuilds"
    if not path_exists(spark, path):
        return None
    done = spark.read.schema("attempt string, buckets int, event_timestamp timestamp, covered array<string>").parquet(path)
    last = done.orderBy(F.desc("event_timestamp")).first()
    return (last.attempt, last.buckets, set(last.covered)) if last else None


def index_width(spark: SparkSession, warehouse: str) -> int:
    """The buckets that loads of this warehouse use: those of its last indexed load or rebuild; 0 if there is none."""
    loads = read_run_events(spark, warehouse).filter("key_buckets > 0").orderBy(F.desc("event_timestamp")).first()
    if loads:
        return loads.key_buckets
    rebuilt = _last_rebuild(spark, warehouse)
    return rebuilt[1] if rebuilt else 0


def _fact_keys(spark: SparkSession, warehouse: str, runs: list[tuple[str, str]]) -> DataFrame:
    folders = [attempt_folder(warehouse, TABLE, run, attempt) for run, attempt in runs]
    return spark.read.schema(RUN_TABLES[TABLE]).option("basePath", f"{warehouse}/{TABLE}").parquet(*folders).select(KEY)


def stored_keys(spark: SparkSession, warehouse: str, buckets: int) -> StoredKeys:
    """The stored keys, from the index as far as it has them in ``buckets`` buckets."""
    index = KeyIndex(_root(warehouse), buckets)
    runs = visible_attempts(read_run_events(spark, warehouse)).collect()
    rebuilt = _last_rebuild(spark, warehouse)
    base, covered = (rebuilt[0], rebuilt[2]) if rebuilt and rebuilt[1] == buckets else (None, set())
    later = [r for r in runs if r.attempt not in covered]
    attempts = ([base] if base else []) + [r.attempt for r in later if r.key_buckets == buckets]
    others = [(r.run_id, r.attempt) for r in later if r.key_buckets != buckets]
    return StoredKeys(index, index.read(spark, attempts) if attempts else None, _fact_keys(spark, warehouse, others) if others else None)


def write_attempt_keys(spark: SparkSession, warehouse: str, buckets: int, run_id: str, attempt: str) -> None:
    """Index the facts that an attempt has written."""
    KeyIndex(_root(warehouse), buckets).write(_fact_keys(spark, warehouse, [(run_id, attempt)]), attempt)


def rebuild(spark: SparkSession, warehouse: str, buckets: int) -> None:
    """Index all facts stored so far in ``buckets`` buckets, in one folder."""
    stored = stored_keys(spark, warehouse, buckets)
    keys = [k for k in (stored.indexed, stored.others) if k is not None]
    covered = [r.attempt for r in visible_attempts(read_run_events(spark, warehouse)).collect()]
    attempt = uuid.uuid4().hex
    if keys:
        stored.index.write(keys[0] if len(keys) == 1 else keys[0].unionByName(keys[1]), attempt)
    else:
        stored.index.write(spark.createDataFrame([], RUN_TABLES[TABLE]), attempt)
    event = [(attempt, buckets, datetime.now(UTC), covered)]
    done = spark.createDataFrame(event, "attempt string, buckets int, event_timestamp timestamp, covered array<string>")
    done.coalesce(1).write.mode("append").parquet(f"{_root(warehouse)}/_rebuilds")
