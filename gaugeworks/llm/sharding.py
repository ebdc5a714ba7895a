"""Sharding by vector bin packing: bytes, tokens and rows of every shard near equal.

Rows with equal texts form a group; a group goes whole to one shard unless it is larger
than a shard's share of bytes, tokens or rows, so that no shard can hold it; then it is cut into a chunk for every shard. Groups are placed,
largest first, on the shard whose residual capacity has the highest dot product with the
group's size vector, both in units of a shard's share. Those above ``LARGE`` of a share in
bytes, tokens or rows, of which there can only be a few per shard, come first and by their sums
alone; their rows are dealt to buckets like any others. The other groups are dealt at random to buckets of a
bounded number of rows, and each bucket places its own against what the large ones have left. The smallest groups, about
``held`` of all bytes, wait: once the loads of all buckets are summed (one row per
shard), they are placed the same way against what the shards still lack.

Slots are numbered inside each bucket and shard and moved by the counts of the buckets
before it, so no shard is sorted in one task.

Defined results: a null text has no bytes and no tokens and groups with other nulls, not
with empty texts; repeated rows each get a slot of their own; a null id is kept; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.tables import rows_of
from gaugeworks.llm.tokens import shared_word_bpe
from gaugeworks.session import settle

OVERHEAD = 16
BUCKET_ROWS = 40_000
#: Groups above this part of a shard's share are placed before all others: 3 / LARGE per shard at most.
LARGE = 0.05
#: Share of the bytes, in the smallest groups, that is placed last.
HELD = 0.05


def measured(df: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Id, size in bytes with overhead, tokens, CRC and a 128-bit key of the text, one narrow row each."""
    source = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = dict(source.dtypes)["id"]

    encoder_here = shared_word_bpe(df.sparkSession, path)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_here()
        for batch in rows_of(batches):
            texts = batch.column("text").to_pylist()
            raw = [(t or "").encode("utf-8") for t in texts]
            tokens = [len(ids) // 4 for ids in encoder.ids_of(texts)]
            columns = [
                batch.column("id"),
                batch.column("text"),
                pa.array([len(r) + OVERHEAD for r in raw], pa.int64()),
                pa.array(tokens, pa.int64()),
                pa.array([zlib.crc32(r) for r in raw], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "text", "size", "tokens", "text_crc32"])

    seen = source.mapInArrow(measure, f"id {kind}, text string, size long, tokens long, text_crc32 long")
    key = F.coalesce(F.md5("text"), F.lit("null"))
    return seen.select(F.col("id").alias(id_column), "size", "tokens", "text_crc32", key.alias("key"))


def _place(vectors: np.ndarray, order: np.ndarray, room: np.ndarray, weights: tuple[float, ...] = (1.0, 1.0, 1.0)) -> np.ndarray:
    """Shard of each vector, taken in ``order``; ``room`` (shards by dimensions) is lowered in place."""
    shard = np.zeros(len(vectors), np.int64)
    for i in order.tolist():
        v = vectors[i]
        # Room is in shares of a shard; the product weighs each dimension by what the group needs of it.
        k = int(np.argmax(room @ (v * weights)))
        shard[i] = k
        room[k] -= v
    return shard


def shard_rows(rows: DataFrame, shards: int, id_column: str = "doc_id", bucket_rows: int = BUCKET_ROWS, held: float = HELD) -> DataFrame:
    """``rows`` (id, size, tokens, text_crc32, key) with shard and slot."""
    rows = settle(rows, "shard")
    total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    n, all_bytes, all_tokens = (int(x) for x in total)
    buckets = max(1, -(-n // bucket_rows))
    share = np.array([all_bytes, all_tokens, n], float) / shards
    unit = np.where(share > 0, share, 1.0)

    groups = rows.groupBy("key").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))
    part = F.greatest(*(F.col(c) / F.lit(float(u)) for c, u in zip(("size", "tokens", "rows"), unit, strict=True)))
    chunks = F.when(part > 1, F.least(F.lit(shards), F.col("rows"))).otherwise(1).cast("long")
    large = settle(groups.select("key", "size", "tokens", "rows", chunks.alias("chunks")).where((part > LARGE) & (F.col("rows") > 1)), "shard")
    cut = large.select("key", "chunks", (F.array("size", "tokens", "rows")).alias("sums"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"))
    few = cut.orderBy("key", "chunk").collect()  # at most 3 / LARGE + 3 per shard
    room = np.ones((shards, len(unit)))
    if few:
        vectors = np.array([[x / r["chunks"] for x in r["sums"]] for r in few]) / unit
        found = _place(vectors, np.argsort(-vectors.max(axis=1), kind="stable"), room)
        places = [(r["key"], r["chunk"], int(k)) for r, k in zip(few, found, strict=True)]
    else:
        places = []
    places = rows.sparkSession.createDataFrame(places, "key string, chunk long, fixed int")
    # Each shard's part of what the other groups may take: the law is bytes, so those decide in every dimension.
    free = np.maximum(room[:, :1], 0) / max(np.maximum(room[:, 0], 0).sum(), 1e-9)

    # Rows of a large group are dealt to its chunks, and to buckets, one by one; other groups go to a bucket whole.
    chunk = F.coalesce(F.floor(F.rand(7) * F.col("chunks")), F.lit(0)).cast("long")
    dealt = rows.join(large.select("key", "chunks"), "key", "left").withColumn("chunk", chunk)
    spread = F.floor(F.rand(11) * buckets).cast("long")
    bucket = F.when(F.col("chunks").isNull(), F.pmod(F.xxhash64("key"), F.lit(buckets))).otherwise(spread)
    dealt = settle(dealt.withColumn("bucket", bucket).drop("chunks"), "shard").join(places, ["key", "chunk"], "left")
    base = f"{', '.join(f'`{a}` {b}' for a, b in dealt.dtypes)}, shard int, slot long"

    def grouped(frame: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
        """One row per group, and each row's group."""
        g = frame.groupby(["key", "chunk"], sort=True, dropna=False)
        sums = g.agg(size=("size", "sum"), tokens=("tokens", "sum"), rows=("size", "count"))
        return sums, g.ngroup().to_numpy()

    def numbered(frame: pd.DataFrame, shard: np.ndarray) -> pd.DataFrame:
        frame = frame.assign(shard=pd.array(shard, "int32"))
        return frame.assign(slot=frame.groupby("shard").cumcount())

    def first(key: tuple[int], frame: pd.DataFrame) -> pd.DataFrame:
        fixed = frame["fixed"].notna().to_numpy()
        shard = frame["fixed"].fillna(-1).to_numpy(np.int64)
        if not fixed.all():
            sums, of = grouped(frame[~fixed])
            vectors = sums.to_numpy(float) / unit
            weight = vectors.max(axis=1)
            order = np.argsort(-weight, kind="stable")
            mass = np.cumsum(sums["size"].to_numpy()[order])
            placed = order[: int(np.searchsorted(mass, (1 - held) * mass[-1], "left")) + 1]
            # Ties go to the first shard, so every bucket counts them from another one.
            room = np.roll(free * vectors.sum(axis=0), -(key[0] % shards), axis=0)
            found = np.full(len(sums), -1, np.int64)
            found[placed] = (_place(vectors, placed, room)[placed] + key[0]) % shards
            shard[~fixed] = found[of]
        return numbered(frame, shard)

    once = settle(dealt.groupBy("bucket").applyInPandas(first, base), "shard")
    loads = once.where("shard >= 0").groupBy("shard").agg(F.sum("size"), F.sum("tokens"), F.count("*")).collect()  # one row per shard
    lack = np.tile(share, (shards, 1))
    for k, size, tokens, count in loads:
        lack[k] -= np.array([size, tokens, count], float)
    waiting = once.where("shard < 0").drop("shard", "slot")
    left = np.maximum(share - np.array([sum(r[i] for r in loads) for i in (1, 2, 3)], float) / shards, 1e-9) * shards

    def second(key: tuple[int], frame: pd.DataFrame) -> pd.DataFrame:
        sums, of = grouped(frame)
        vectors = sums.to_numpy(float) / unit
        part = vectors.sum(axis=0) * unit / left  # this bucket's part of all that waits
        room = lack / unit * part
        order = np.argsort(-vectors.max(axis=1), kind="stable")
        return numbered(frame, _place(vectors, order, room, (1.0, 0.0, 0.0))[of])

    # Buckets of the second round are numbered after those of the first.
    late = waiting.withColumn("bucket", F.floor(F.col("bucket") / F.lit(max(1, round(1 / max(held, 1e-6))))).cast("long"))
    twice = settle(late.groupBy("bucket").applyInPandas(second, base).withColumn("bucket", F.col("bucket") + F.lit(buckets)), "shard")
    placed = once.where("shard >= 0").unionByName(twice)
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = settle(counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("moved")), "shard")
    return (
        placed.join(offsets, ["shard", "bucket"])
        .select(id_column, "size", "tokens", "text_crc32", "shard", (F.col("slot") + F.col("moved")).alias("slot"))
    )
