"""Approximate nearest neighbours by largest inner product, with shifted Hilbert curves.

Vectors are lifted by one component to equal length, so that the largest inner product
is the least distance. Each of several curves projects them at random to a few
dimensions, shifts and quantizes them and orders them along a Hilbert curve. Orderings
are range-partitioned and sorted by Spark; ranks cut each into windows of ``window``
rows, or of one part in ``parts`` of the entries where that is more, so that what a query
meets follows the table. A query meets the window it falls into and both neighbours, so
at least a window of rows on either side on each curve; hits are rescored in double
precision on the original vectors, and the best of all curves are kept. A wide window is
met in blocks of ``block`` of its rows, each with one block of the queries, which bounds
what a task holds.

Equal vectors are one entry of the index. Of an entry no more ids are kept than a result
can hold, so copies of one vector neither fill windows nor make rows.

The index holds every row. Vectors without any structure (64 independent dimensions) are
the hardest; recall on such tables is in the README. Windows that follow the table make
the number of scores grow with its square, as such vectors need; what is shuffled grows
with its rows while a window is one block.

Defined results: vectors that are null, zero, of another length than most, or that hold
a null or a component that is not finite take no part, nor do rows with a null id; of
equal scores the smaller id comes first; a query with fewer candidates gets all of them;
an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.tables import rows_of
from gaugeworks.session import settle

CURVES = 24
DIMENSIONS = 16
BITS = 3
#: Rows of a window: at least ``WINDOW``, and one part in ``PARTS`` of the entries.
WINDOW, PARTS = 1024, 50
#: Rows of a window that one task holds at a time, and scores that it holds.
BLOCK, SCORES = 32_768, 4_000_000


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions along the Hilbert curve of cells (rows by dimensions, each below 2^bits).

    The transform of axes to transposed index by Skilling, over all rows at once.
    """
    x = cells.T.astype(np.int64).copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(n):
            on = (x[i] >> level & 1).astype(bool)
            swapped = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swapped)
            x[i] ^= swapped
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[n - 1] >> level & 1, (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | x[i] >> level & 1
    return key


def _usable(df: DataFrame, is_query: Column, id_column: str, vector_column: str) -> DataFrame:
    """(id, vector, query) of rows that take part."""
    v = F.col("vector")
    rows = df.select(F.col(id_column).alias("id"), F.col(vector_column).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("query")).where("id is not null and vector is not null")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(finite & F.exists(v, lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n"))
    common = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    return rows.where(F.size("vector") == (common["d"] if common else 0))


def _entries(rows: DataFrame, k: int) -> DataFrame:
    """(id, vector, entry, rn): the first ``k`` + 1 ids of each distinct vector; its entry is the first of them."""
    same = Window.partitionBy("h1", "h2")
    named = rows.select("id", "vector", F.xxhash64("vector").alias("h1"), F.hash("vector").alias("h2"))
    least = named.groupBy("h1", "h2").agg(F.min("id").alias("entry"))
    first = named.withColumn("rn", F.row_number().over(same.orderBy("id"))).where(F.col("rn") <= k + 1)
    return first.join(least, ["h1", "h2"]).select("id", "vector", "entry", "rn", "h1", "h2")


def _moments(index: DataFrame) -> tuple[int, np.ndarray, float, float]:
    """Entries, mean of the lifted vector, deviation of a component about it, and greatest length."""
    by = index.select(F.posexplode("vector").alias("i", "x")).groupBy("i").agg(F.avg(F.col("x").cast("double")).alias("m"), F.var_pop(F.col("x").cast("double")).alias("v"))
    rows = by.orderBy("i").collect()  # one row per component
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, most = index.agg(F.count("*"), F.max(squares)).first()
    lifted = index.agg(F.avg(F.sqrt(F.greatest(F.lit(most or 0.0) - squares, F.lit(0.0))))).first()[0] or 0.0
    mean = np.array([r["m"] for r in rows] + [lifted] * bool(rows))
    return n, mean, float(np.sqrt(max(np.mean([r["v"] for r in rows]), 1e-300))) if rows else 1.0, float(np.sqrt(most or 0.0))


def _keys(index: DataFrame, mean: np.ndarray, spread: float, longest: float, curves: int, dimensions: int, bits: int) -> DataFrame:
    """(curve, key, entry, asks) of every entry, and of every entry that is asked for as a query."""
    d = len(mean) - 1
    dims = min(dimensions, d + 1)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 8192):
            x = np.array(batch.column("vector").flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, d)
            asked = batch.column("asked").to_numpy(zero_copy_only=False)
            entry = batch.column("entry").to_numpy()
            length = np.linalg.norm(x, axis=1)
            items = np.c_[x, np.sqrt(np.maximum(longest**2 - length**2, 0))] - mean
            queries = np.c_[x[asked] * (longest / length[asked])[:, None], np.zeros(int(asked.sum()))] - mean
            for c in range(curves):
                random = np.random.default_rng(1_000 + c)
                axes = np.linalg.qr(random.normal(size=(d + 1, dims)))[0]
                shift = random.random(dims)
                for rows, names, asks in ((items, entry, False), (queries, entry[asked], True)):
                    cells = np.floor(rows @ axes / spread + shift).astype(np.int64) + (1 << bits - 1)
                    place = hilbert_keys(np.clip(cells, 0, (1 << bits) - 1), bits)
                    columns = [np.full(len(place), c, np.int32), place, names, np.full(len(place), asks)]
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns], names=["curve", "key", "entry", "asks"])

    return index.mapInArrow(key, "curve int, key long, entry long, asks boolean")


def _windows(keys: DataFrame, window: int, block: int) -> DataFrame:
    """(curve, entry, asks, win, part): the window of every row by its rank on its curve, and its block there."""
    order = ["curve", "key", "entry", "asks"]
    at = settle(keys.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "curves")
    part = F.shiftright("at", 33)
    counts = at.groupBy(part.alias("part"), "curve").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = settle(counts.select("part", "curve", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "curves")
    ranked = at.withColumn("part", part).join(starts, ["part", "curve"])
    rank = F.col("at") - F.col("first") + F.col("before")
    return ranked.select("curve", "entry", "asks", F.floor(rank / F.lit(window)).cast("long").alias("win"), F.floor(rank % F.lit(window) / F.lit(block)).cast("int").alias("part"))


def nearest(
    df: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding",
    curves: int = CURVES, dimensions: int = DIMENSIONS, bits: int = BITS, window: int = WINDOW,
    parts: int = PARTS, block: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, id, score): the nearest found of every row where ``is_query`` holds, itself left out."""
    rows = _usable(df, is_query, id_column, vector_column)
    entries = settle(_entries(rows, k), "entries")
    asking = rows.where("query").select("id", F.xxhash64("vector").alias("h1"), F.hash("vector").alias("h2")).distinct()
    names = entries.where("rn = 1").select("h1", "h2", "entry")
    queries = settle(asking.join(names, ["h1", "h2"]).select(F.col("id").alias("query_id"), "entry"), "queries")
    asked = queries.select("entry").distinct().withColumn("hit", F.lit(True))
    index = entries.where("rn = 1").select("entry", "vector").join(asked, "entry", "left")
    index = settle(index.select("entry", "vector", F.coalesce("hit", F.lit(False)).alias("asked")), "index")
    n, mean, spread, longest = _moments(index)
    if not len(mean):
        return queries.select("query_id", F.lit(1).alias("rank"), F.col("entry").alias(id_column), F.lit(0.0).alias("score")).limit(0)

    window = max(window, -(-n // parts))
    placed = _windows(_keys(index, mean, spread, longest, curves, dimensions, bits), window, block)
    near = F.when(F.col("asks"), F.array(F.col("win") - 1, F.col("win"), F.col("win") + 1)).otherwise(F.array("win"))
    dealt = placed.join(index.select("entry", "vector"), "entry").select("curve", F.explode(near).alias("win"), "part", "entry", "asks", "vector")
    # Each block of a window's rows meets each block of the queries.
    blocks = -(-window // block)
    if blocks > 1:
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    else:
        dealt = dealt.withColumn("other", F.lit(0))
    sides = [F.when(F.col("asks"), F.col(a)).otherwise(F.col(b)).alias(name) for a, b, name in (("other", "part", "of_rows"), ("part", "other", "of_queries"))]
    dealt = dealt.select("curve", "win", *sides, "entry", "asks", "vector")

    def scores(q: np.ndarray, x: np.ndarray, q_ids: np.ndarray, x_ids: np.ndarray) -> list[np.ndarray]:
        rough = q @ x.T
        kept = min(k + 1, len(x))
        floor = np.partition(rough, len(x) - kept, axis=1)[:, len(x) - kept]
        slack = 1e-9 * (1 + np.abs(rough).max())
        i, j = np.nonzero(rough >= floor[:, None] - slack)
        score = (q[i] * x[j]).sum(axis=1)  # the same for a pair wherever it meets
        order = np.lexsort((x_ids[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        start = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]]))
        nth = np.arange(len(i)) - np.repeat(start, np.diff(np.append(start, len(i))))
        top = nth < kept
        return [q_ids[i[top]], x_ids[j[top]], score[top]]

    def best(frame: pd.DataFrame) -> pd.DataFrame:
        asks = frame["asks"].to_numpy(bool)
        vectors = np.array(frame["vector"].tolist(), np.float64)
        ids = frame["entry"].to_numpy()
        q, x, q_ids, x_ids = vectors[asks], vectors[~asks], ids[asks], ids[~asks]
        found = []
        if len(q) and len(x):
            step = max(1, SCORES // len(x))
            pieces = [scores(q[i : i + step], x, q_ids[i : i + step], x_ids) for i in range(0, len(q), step)]
            found = [np.concatenate(c) for c in zip(*pieces, strict=True)]
        columns = found or [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        return pd.DataFrame(dict(zip(("query", "hit", "score"), columns, strict=True)))

    hits = dealt.groupBy("curve", "win", "of_rows", "of_queries").applyInPandas(best, "query long, hit long, score double")
    hits = hits.groupBy("query", "hit").agg(F.max("score").alias("score"))
    by_entry = Window.partitionBy("query").orderBy(F.desc("score"), "hit")
    hits = hits.withColumn("rn", F.row_number().over(by_entry)).where(F.col("rn") <= k + 1).drop("rn")
    # From entries to their rows: the first ids of each are enough.
    members = entries.select(F.col("entry").alias("hit"), "id")
    by_row = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    listed = hits.join(members, "hit").withColumn("rn", F.row_number().over(by_row)).where(F.col("rn") <= k + 1).select("query", "id", "score")
    listed = settle(listed, "hits")
    own = queries.join(listed, queries["entry"] == listed["query"]).where("query_id != id")
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = own.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_column), "score")
