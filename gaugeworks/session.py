"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROWS_PER_PARTITION = 4_000_000
MOST_PARTITIONS = 50_000

_local_scratch: str | None = None


def build_session(app_name: str = "gaugeworks", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC, ANSI and adaptive execution on and the web page off.

    Shuffle width is left to the cluster: adaptive execution coalesces from
    whatever ``spark.sql.shuffle.partitions`` the deployment sets.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Recording the Python call site of every column costs more than small queries.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session that names none gets a machine-local folder; on a
    cluster such a folder would not be visible to the executors.
    """
    global _local_scratch
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="gaugeworks-")
    return _local_scratch


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Used on aggregates that several later steps share. The step is computed once,
    survives the loss of an executor, and its file size is known to the optimizer,
    which then broadcasts it only when it is below
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise joins by shuffle with
    adaptive skew splitting.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for a while."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def shuffle_width(spark: SparkSession, rows: int) -> Iterator[None]:
    """Plan shuffles of ``rows`` rows wide enough for a partition to fit in memory.

    The session's setting is only ever raised, and put back at the end; adaptive
    execution merges partitions that turn out small.
    """
    key = "spark.sql.shuffle.partitions"
    wanted = min(rows // ROWS_PER_PARTITION + 1, MOST_PARTITIONS)
    with setting(spark, key, str(max(int(spark.conf.get(key)), wanted))):
        yield
