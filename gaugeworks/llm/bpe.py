"""Byte-level BPE of whole texts, and back, by tree concatenation.

A short text is encoded at once. A long one is halved until its leaves are short; the
leaves are dealt to all tasks and encoded in parallel, then neighbours are joined in a
tree. A join re-encodes a window around the cut that starts and ends at tokens of the
two sides, and doubles it until both sides agree with it exactly: a position well away
from the cut where the token before and the token after are the same on the side and in
the window. Merges by rank give the one sequence in which every neighbouring pair
stands when encoded alone, so side, window and side put together at such positions are
the ids of the whole.

Defined results: a null text counts as empty and has no ids; rows with the same id are
encoded one by one; a null id stays null; an empty table gives an empty table; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.tables import rows_of
from gaugeworks.llm.tokens import byte_bpe, byte_bpe_bytes

#: Characters of a text from which on it is encoded in halves, and of a leaf.
LONG = 65_536
LEAF = 16_384
#: Bytes from the cut within which no agreement counts: more than a special string or a contraction has.
GUARD = 16


@dataclass(frozen=True)
class Encoded:
    data: bytes
    ids: np.ndarray
    ends: np.ndarray  # byte position after each id


def leaves(text: str, leaf: int = LEAF) -> list[str]:
    """The text halved until no part is longer than ``leaf`` characters."""
    if len(text) <= max(leaf, 1):
        return [text]
    middle = len(text) // 2
    return leaves(text[:middle], leaf) + leaves(text[middle:], leaf)


def encode(text: str, path: str) -> np.ndarray:
    return byte_bpe(path).encode_to_numpy(text, allowed_special="all").astype("<u4")


def _encoded(text: str, path: str, ids: np.ndarray | None = None) -> Encoded:
    ids = encode(text, path) if ids is None else ids
    return Encoded(text.encode("utf-8"), ids, _ends(ids, path))


def _ends(ids: np.ndarray, path: str) -> np.ndarray:
    table = byte_bpe_bytes(path)
    return np.cumsum(np.fromiter((len(table[i]) for i in ids.tolist()), np.int64, len(ids)))


def _edge(data: bytes, ends: np.ndarray, at: int, step: int) -> int:
    """The nearest token boundary from ``at`` on, going by ``step``, that starts a character."""
    k = int(np.searchsorted(ends, at, "right" if step < 0 else "left")) - (step < 0)
    while 0 <= k < len(ends) and ends[k] < len(data) and data[ends[k]] & 0xC0 == 0x80:
        k += step
    return 0 if k < 0 else len(data) if k >= len(ends) else int(ends[k])


def _agreed(side: Encoded, ids: np.ndarray, ends: np.ndarray, shift: int, low: int, high: int) -> tuple[int, int] | None:
    """Indices of the ids that follow a common boundary in [low, high] with equal ids on both sides of it.

    ``shift`` is the window's start in the side's own byte positions.
    """
    _, here, there = np.intersect1d(side.ends, ends + shift, assume_unique=True, return_indices=True)
    at = side.ends[here]
    fits = (at >= low) & (at <= high) & (here + 1 < len(side.ids)) & (there + 1 < len(ids))
    here, there = here[fits], there[fits]
    same = (side.ids[here] == ids[there]) & (side.ids[here + 1] == ids[there + 1])
    if not same.any():
        return None
    k = int(np.flatnonzero(same)[0])
    return int(here[k]) + 1, int(there[k]) + 1


def concatenate(left: Encoded, right: Encoded, path: str, window: int = 32) -> Encoded:
    """The encoding of both texts together."""
    if not len(left.ids) or not len(right.ids):
        return right if not len(left.ids) else left
    cut, data = len(left.data), left.data + right.data
    while True:
        low = _edge(left.data, left.ends, cut - window, -1) if window < cut else 0
        high = _edge(right.data, right.ends, window, 1) if window < len(right.data) else len(right.data)
        ids = encode(data[low : cut + high].decode("utf-8"), path)
        ends = _ends(ids, path)
        first = (0, 0) if low == 0 else _agreed(left, ids, ends, low, low + 1, cut - GUARD)
        last = (len(right.ids), len(ids)) if high == len(right.data) else _agreed(right, ids, ends, low - cut, GUARD, high - 1)
        if first and last:
            joined = np.concatenate([left.ids[: first[0]], ids[first[1] : last[1]], right.ids[last[0] :]])
            joined_ends = np.concatenate([left.ends[: first[0]], ends[first[1] : last[1]] + low, right.ends[last[0] :] + cut])
            return Encoded(data, joined, joined_ends)
        window *= 2


def encode_in_tree(parts: list[Encoded], path: str) -> Encoded:
    """Neighbours joined level by level."""
    while len(parts) > 1:
        pairs = [concatenate(a, b, path) for a, b in itertools.batched(parts[: len(parts) // 2 * 2], 2)]
        parts = pairs + parts[len(parts) // 2 * 2 :]
    return parts[0]


def decode(ids: np.ndarray, path: str) -> bytes:
    """The text of ids in UTF-8, special tokens included."""
    data = b"".join(map(byte_bpe_bytes(path).__getitem__, ids.tolist()))
    return data.decode("utf-8", "replace").encode("utf-8")


def with_ids(df: DataFrame, id_column: str, text_column: str, path: str, make: Callable[[np.ndarray], tuple], result: str, long: int = LONG, leaf: int = LEAF) -> DataFrame:
    """``id_column`` and what ``make`` gives for the ids of each text, as the columns of ``result``.

    Only the leaves of long texts are shuffled; the parts of one text meet in one task, which
    then holds that text once.
    """
    source = df.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    schema = f"id {dict(source.dtypes)['id']}, {result}"

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows_of(batches):
            found = [make(encode(text, path)) for text in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("id"), *map(pa.array, zip(*found, strict=True))], names=names)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for key, i, text in frame.itertuples(index=False):
                for k, part in enumerate(leaves(text, leaf)):
                    yield pd.DataFrame({"key": [key], "id": pd.array([i], frame["id"].dtype), "leaf": [k], "text": [part]})

    def encoded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(ids=[encode(t, path).tobytes() for t in frame["text"]])

    def joined(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("leaf")
        parts = [_encoded(t, path, np.frombuffer(b, "<u4")) for t, b in zip(frame["text"], frame["ids"], strict=True)]
        values = make(encode_in_tree(parts, path).ids)
        return pd.DataFrame([[frame["id"].iloc[0], *values]], columns=names).astype({"id": frame["id"].dtype})

    names = ["id", *(x.split()[0] for x in result.split(", "))]
    kind = dict(source.dtypes)["id"]
    wide = source.where(F.length("text") > long).select(F.monotonically_increasing_id().alias("key"), "id", "text")
    parts = wide.mapInPandas(cut, f"key long, id {kind}, leaf int, text string")
    parts = parts.repartition("key", "leaf").mapInPandas(encoded, f"key long, id {kind}, leaf int, text string, ids binary")
    whole = source.where(F.length("text") <= long).mapInArrow(short, schema)
    return whole.unionByName(parts.groupBy("key").applyInPandas(joined, schema)).withColumnRenamed("id", id_column)


def round_trip(df: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", long: int = LONG, leaf: int = LEAF) -> DataFrame:
    """Per row the number of ids, their digest, and the digest of the text decoded from them."""

    def digests(ids: np.ndarray) -> tuple[int, str, str]:
        return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(decode(ids, path)).hexdigest()

    result = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return with_ids(df, id_column, text_column, path, digests, result, long, leaf)
