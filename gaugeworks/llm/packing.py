"""Best-fit packing of token sequences with bounds that certify it.

Texts are encoded, the end id is added and only what is longer than the capacity is cut.
The pieces are dealt at random to buckets of a bounded number of rows. Each bucket runs
best-fit decreasing and compares its number of bins with lower bounds from dual-feasible
functions. Where they are equal the bucket is certified: its bins stay, but for the
emptiest. Where a gap remains only its full bins stay. What did not stay is dealt anew,
to fewer buckets, so that buckets exchange pieces, until one bucket holds the rest or a
round keeps next to nothing. The last round compares with the bound as well, and the result
says of every sequence whether it is certified.

Defined results: a null text counts as empty and gives one piece, the end id; rows with
the same id are packed one by one; a null id stays null; an empty table gives an empty
table; other columns are not read.
"""

from __future__ import annotations

import itertools
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.tables import rows_of
from gaugeworks.llm.tokens import shared_word_bpe
from gaugeworks.session import settle

CAPACITY = 2048
#: Pieces of a bucket, on average.
BUCKET_ROWS = 20_000
#: Exchange goes on while a round leaves at most this share of its pieces.
MOST_LEFT = 0.75


def pieces(df: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Id, piece, ids of the text before it, length and CRC of its ids, for every piece of every text."""
    source = df.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    schema = f"id {dict(source.dtypes)['id']}, piece int, start long, length long, ids_crc32 long"
    end = struct.pack("<I", end_id)

    encoder_here = shared_word_bpe(df.sparkSession, path)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_here()
        for batch in rows_of(batches):
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(encoder.ids_of(batch.column("text").to_pylist())):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            columns = [batch.column("id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "piece", "start", "length", "ids_crc32"])

    return source.mapInArrow(cut, schema).withColumnRenamed("id", id_column)


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Per item its bin, and per item the room taken in that bin before it."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, n = 0, 0  # bit r of rooms: some bin has room r
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            held = by_room[room]
            b = held.pop()
            if not held:
                rooms ^= 1 << room
        else:
            room, b, n = capacity, n, n + 1
        bins[i], offsets[i] = b, capacity - room
        left = room - size
        if left:
            by_room[left].append(b)
            rooms |= 1 << left
    return bins, offsets


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """The best of three families of dual-feasible functions over the sizes.

    The sizes themselves; sizes up to a threshold t dropped and those over capacity - t
    taken as full, for all t; and sizes rounded down to multiples of 1/k as shares of
    capacity where (k + 1) times the share is no integer.
    """
    if not len(sizes):
        return 0
    count = np.bincount(sizes, minlength=capacity + 1).astype(np.int64)
    x = np.arange(capacity + 1)
    best = -(-int((count * x).sum()) // capacity)
    below, mass = np.r_[0, np.cumsum(count)], np.r_[0, np.cumsum(count * x)]  # of sizes < i
    t = np.arange(1, capacity // 2 + 1)
    over = below[capacity + 1] - below[capacity - t + 1]
    middle = mass[capacity - t + 1] - mass[t]
    best = max(best, int((over + -(-middle // capacity)).max(initial=0)))
    for k in range(1, 33):
        shares = (k + 1) * x
        # In units of capacity / k, so that all is whole: k * x / capacity where it divides.
        value = np.where(shares % capacity == 0, k * x, shares // capacity * capacity)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best


def _packer(turn: int, last: bool, capacity: int, length_column: str) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    """Packs a bucket; rows of bins that do not stay get the sequence -1."""

    def packed(key: tuple[int], frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop(columns="__bucket")
        sizes = frame[length_column].to_numpy(np.int64)
        bins, offsets = best_fit_decreasing(sizes, capacity)
        load = np.bincount(bins, weights=sizes).astype(np.int64)
        fewest = len(load) == lower_bound(sizes, capacity)
        if last:
            stays = np.ones(len(load), bool)
        elif fewest:
            stays = np.arange(len(load)) != np.argmin(load)
        else:
            stays = load == capacity
        number = (turn << 56) + (key[0] << 24) + bins
        return frame.assign(sequence_id=np.where(stays[bins], number, -1), offset=offsets, certified=fewest | (load == capacity)[bins])

    return packed


def pack(df: DataFrame, capacity: int = CAPACITY, length_column: str = "length", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``df`` with the sequence of every row, its offset there, and whether the sequence is certified.

    A sequence is certified if no packing of its bucket's rows has fewer sequences, or if
    it is full. Every round is written to the scratch folder, since dealing depends on row
    order. ``length_column`` holds whole numbers from 1 to ``capacity``. Columns of ``df``
    that are named as those of the result are replaced.
    """
    df = df.drop("sequence_id", "offset", "certified", "__bucket")
    schema = f"{', '.join(f'`{n}` {t}' for n, t in df.dtypes)}, sequence_id long, offset long, certified boolean"
    kept, before = None, None
    rest = settle(df, "pack")
    for turn in itertools.count():
        n = rest.count()
        buckets = max(1, -(-n // bucket_rows))
        # Nothing closes the gaps any more when a round has kept next to nothing.
        last = buckets == 1 or (before is not None and n > before * MOST_LEFT)
        dealt = rest.withColumn("__bucket", (F.rand(turn + 1) * buckets).cast("long"))
        done = settle(dealt.groupBy("__bucket").applyInPandas(_packer(turn, last, capacity, length_column), schema), "pack")
        settled = done.where("sequence_id >= 0")
        kept = settled if kept is None else kept.unionByName(settled)
        if last:
            return kept
        rest, before = done.where("sequence_id < 0").drop("sequence_id", "offset", "certified"), n
    raise AssertionError("the loop ends by return")
