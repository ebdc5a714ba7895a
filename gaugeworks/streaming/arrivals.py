"""Load new files of a folder, each exactly once.

The stream only finds the new files; every micro-batch is one ordinary load. Its run
id is made from the source's path, the stream's id and the batch number: a batch that is
replayed has its earlier id and is not loaded twice, while a stream that has lost its
progress starts with new ids, and its rows meet the stored ones by key as in any load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeworks.plans.ingest import run_ingest
from gaugeworks.schemas import ROW
from gaugeworks.sources.files import stream_source
from gaugeworks.sources.spec import SourceSpec


def load_arrivals(
    spark: SparkSession, spec: SourceSpec, warehouse: str, files_per_batch: int | None = None
) -> StreamingQuery:
    """Start loading all files not loaded yet; the query ends when there are none.

    Progress is kept below the warehouse folder, one place per source path. Files count
    as new whatever their date, so the stream remembers every name it has seen.
    """

    def load(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn(ROW, F.monotonically_increasing_id())
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        run_ingest(batch.sparkSession, spec, warehouse, f"{spec.key}-{stream}-{number}", source=rows)

    return (
        stream_source(spark, spec, files_per_batch)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", f"{warehouse}/_progress/{spec.key}")
        .trigger(availableNow=True)
        .start()
    )
