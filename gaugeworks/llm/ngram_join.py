"""N-gram Jaccard self-join by partition enumeration (PartEnum signatures), and its components.

Sets of shingles whose sizes lie in one band [4^j, 4^(j+1)) share a scheme: the domain of
shingles is cut into N_j partitions by hash. What a set holds of one partition, taken
together, is a signature. Two sets a <= b with Jaccard at least t differ in at most
d = (a + b)(1 - t)/(1 + t) shingles, hence in at most d partitions; so among the
first D + 1 signatures of each, in one order of all signatures, at least one is shared, D
being the largest d a set can have with any partner. A set whose partners may lie in
the next band also gives signatures of that band's scheme. A set whose shingles fall
into no more than D partitions also gives one common signature; two sets that the rule
could miss both do so. Hence no link is lost.

The order takes frequent shingles last, by counts over all documents in cells of the domain,
which only changes which signatures are used, not what is found.

Shuffle files of a step go when its result is written, so that disk follows the largest
step and not their sum.

1. One pass over the texts: size, name of the set, a sketch of counters over cells of the
   domain, about one cell for eight shingles, and counts of shingles by cell. Equal sets
   are one node from here on, and one text of each is read again.
2. Signatures, one shuffle. A run of equal signatures gives the pairs of its first member
   with the others, and its member list if it has three and more, so that what is kept of
   a run grows with its length and not with its pairs.
3. Pairs whose counters differ by more than d in sum cannot link and go; the others are
   verified with their whole sets. First members' pairs come first; after that, only runs
   that still hold several components are looked at: their members' counters are compared
   where components differ, and near pairs are verified.
4. Where such a run is too long for one task, or lists too many near pairs, its members form
   a family: families are cut into blocks and every two blocks that may hold an unseen link
   are compared with whole sets, as a product of matrices. Such a task returns a spanning
   forest of its links, so no pair list of a group is made.

Defined results: null and empty texts, and texts of white space, have no shingles and
link with nothing, also not with each other; rows that share an id are one document of
which any text may link; a null id gets a row with the component of its text's other
documents, null if there are none; an empty table gives an empty table; other columns are
not read. Two different sets share a name with a chance of n^2 / 2^65.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.components import connected_components
from gaugeworks.llm.shingles import WORDS, mix, set_hash, shingle_sets
from gaugeworks.llm.tables import rows_of
from gaugeworks.session import setting, settle

#: Least Jaccard similarity of a link, in hundredths.
THRESHOLD = 75
#: Members of a run that are held at a time; documents of a block.
RUN = 32
BLOCK = 512
#: Members of a run, and bytes of their sketches, up to which one task compares them; near pairs for each member beyond which they are no longer listed.
COMPARED = 2048
SKETCHED = 16 << 20
LISTED = 8
LEAST_CELLS = 64
#: Member lists that a task remembers.
TOLD = 200_000
#: Kinds of rows that runs give.
FIRST, OTHER, MEMBER = 0, 1, 2
#: Cells of the domain in which shingles are counted, and stripes of cells that one row holds; 2 bytes a cell, 8 MB, go to the tasks.
COUNTED = 1 << 22
STRIPES = 256
#: Nodes up to which the list of wanted nodes goes to all tasks: 8 bytes each.
WANTED = 1_000_000
#: Spark's switch for dropping the shuffle files of a write as soon as it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SALT = np.uint64(0x9E3779B97F4A7C17)
_STRIPE = COUNTED // STRIPES
_CELL_BITS = np.uint64(64 - COUNTED.bit_length() + 1)


def partner_limit(size: int, most: int | None = None, threshold: int = THRESHOLD) -> int:
    """The most shingles in which a set of ``size`` may differ from a partner of up to ``most`` shingles."""
    largest = size * 100 // threshold
    largest = largest if most is None else min(largest, most)
    return (size + largest) * (100 - threshold) // (100 + threshold)


def schemes(size: int, threshold: int = THRESHOLD) -> list[tuple[int, int, int]]:
    """(band, partitions, D) of the schemes that a set of ``size`` takes part in."""
    band = (size.bit_length() - 1) // 2
    out = []
    for j in (band, band + 1):
        top = 4 ** (j + 1)
        if size * 100 // threshold >= 4**j:
            partitions = 1 << 20 if top <= 16 else top if top <= 64 else top // 2
            out.append((j, partitions, partner_limit(size, top - 1, threshold)))
    return out


def signatures(shingles: np.ndarray, names: np.ndarray, weights: np.ndarray, threshold: int = THRESHOLD) -> np.ndarray:
    """Signatures of a set; ``names`` are shingles, ascending, ``weights`` how common they are; others count as not common at all."""
    place = np.minimum(np.searchsorted(names, shingles), max(len(names) - 1, 0))
    weight = np.where(names[place] == shingles, weights[place], 0) if len(names) else np.zeros(len(shingles), np.int64)
    mixed = mix(shingles)
    out = []
    for band, partitions, most in schemes(len(shingles), threshold):
        part = (shingles >> np.uint64(20)) % np.uint64(partitions)
        order = np.argsort(part, kind="stable")
        part = part[order]
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        held = np.add.reduceat(mixed[order], first)
        rank = np.minimum.reduceat(weight[order], first)  # as rare as its rarest shingle
        name = mix(mix(held + part[first]) + np.uint64(band + 1) * _SALT)
        out.append(name[np.lexsort((name, rank))[: most + 1]])
        if len(first) <= most:
            out.append(np.full(1, mix(np.full(1, np.uint64(band + 1)))[0]))
    return np.concatenate(out)


def cells(size: int) -> int:
    """Cells of a set's sketch: a power of two, the same for all sets of a band."""
    band = (size.bit_length() - 1) // 2
    return max(LEAST_CELLS, 4 ** (band + 1) // 8)


def sketch(shingles: np.ndarray) -> bytes:
    """Shingles per cell of the domain, capped; the sum of two sketches' differences never exceeds that of the sets."""
    n = cells(len(shingles))
    counts = np.bincount((shingles >> np.uint64(10)).astype(np.int64) & (n - 1), minlength=n)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def sketch_distance(a: bytes, b: bytes) -> int:
    """Sum of the differences of two sketches, the finer one folded to the cells of the other."""
    x, y = np.frombuffer(a, np.uint8).astype(np.int32), np.frombuffer(b, np.uint8).astype(np.int32)
    n = min(len(x), len(y))
    x, y = x.reshape(-1, n).sum(axis=0), y.reshape(-1, n).sum(axis=0)
    # A capped cell may hold more than it says, so folding keeps the cap.
    return int(np.abs(np.minimum(x, 255) - np.minimum(y, 255)).sum())


def _profiles(df: DataFrame, words: int) -> DataFrame:
    """Rows of two kinds: (id, size, node, sketch) of a document, and (null, stripe, null, counts) of a task's shingles in one stripe of the cells."""
    kind = dict(df.dtypes)["id"]

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "n", "node", "sketch", "counted"]
        counts, held, size, id_type = np.zeros(COUNTED, np.int32), [], 0, None

        def count() -> None:
            if held:
                np.add(counts, np.bincount(_cell(np.concatenate(held)), minlength=COUNTED), out=counts, casting="unsafe")
                held.clear()

        for batch in rows_of(batches):
            id_type = batch.column("id").type
            sets = shingle_sets(batch.column("text").to_pylist(), words)
            columns = [
                batch.column("id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([set_hash(s) if len(s) else None for s in sets], pa.int64()),
                pa.array([sketch(s) if len(s) else None for s in sets], pa.binary()),
                pa.array(np.zeros(len(sets), bool)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)
            held += sets
            size += sum(map(len, sets))
            if size > 500_000:
                count()
                size = 0
        count()
        stripes = [k for k in range(STRIPES) if counts[k * _STRIPE : (k + 1) * _STRIPE].any()]
        if stripes:
            n = len(stripes)
            blobs = [_squeeze(counts[k * _STRIPE : (k + 1) * _STRIPE]) for k in stripes]
            columns = [pa.nulls(n, id_type), pa.array(stripes, pa.int64()), pa.nulls(n, pa.int64()), pa.array(blobs, pa.binary()), pa.array(np.ones(n, bool))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(profile, f"id {kind}, n long, node long, sketch binary, counted boolean")


def _cell(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> _CELL_BITS).astype(np.int64)


def _squeeze(counts: np.ndarray) -> bytes:
    return zlib.compress(np.minimum(counts, 65535).astype("<u2").tobytes(), 1)


def _common(profiles: DataFrame) -> np.ndarray:
    """How often the shingles of each cell occur, over all documents: bounded by ``COUNTED``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for stripe, blob in zip(batch.column("n").to_pylist(), batch.column("sketch"), strict=True):
                own = sums.setdefault(stripe, np.zeros(_STRIPE, np.int64))
                own += np.frombuffer(zlib.decompress(blob.as_py()), "<u2")
        for stripe, own in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([stripe], pa.int64()), pa.array([own.astype("<i8").tobytes()], pa.binary())], names=["n", "counts"])

    out = np.zeros(COUNTED, np.int64)
    for row in profiles.where("counted").select("n", "sketch").repartition("n").mapInArrow(add, "n long, counts binary").toLocalIterator():
        out[row["n"] * _STRIPE : (row["n"] + 1) * _STRIPE] = np.frombuffer(row["counts"], "<i8")
    # Two bytes each: coarser where the cells hold very much.
    return np.minimum(out >> max(0, int(out.mean()).bit_length() - 13), 65535).astype(np.uint16)


def _signed(df: DataFrame, words: int, common: Broadcast, threshold: int) -> DataFrame:
    """(signature, node, size) of every set, once per task where a task meets it again."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = common.value
        seen: set[int] = set()
        for batch in rows_of(batches):
            found, nodes, sizes = [], [], []
            with np.errstate(over="ignore"):
                for s in shingle_sets(batch.column("text").to_pylist(), words):
                    node = set_hash(s) if len(s) else None
                    if node is not None and node not in seen:
                        seen.add(node)
                        own = signatures(s, s, counts[_cell(s)].astype(np.int64), threshold)
                        found.append(own)
                        nodes.append(np.full(len(own), node))
                        sizes.append(np.full(len(own), len(s), np.int32))
            if found:
                columns = [np.concatenate(found).astype(np.int64), np.concatenate(nodes), np.concatenate(sizes)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["signature", "node", "size"])

    return df.mapInArrow(sign, "signature long, node long, size int")


def _pair_batch(kind: int, a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    x, y = np.concatenate(a), np.concatenate(b)
    both = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1), axis=0)
    return _kind_batch(kind, both[:, 0], both[:, 1])


def _kind_batch(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    kinds = np.full(len(a), kind, np.int32)
    return pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(a), pa.array(b)], names=["kind", "a", "b"])


def _list_names(nodes: np.ndarray) -> np.ndarray:
    """A name for each row of node names."""
    with np.errstate(over="ignore"):
        place = np.arange(1, nodes.shape[1] + 1, dtype=np.uint64) * _SALT
        return mix(mix(nodes.astype(np.uint64) + place).sum(axis=1, dtype=np.uint64)).astype(np.int64)


def _runs(signed: DataFrame, threshold: int) -> DataFrame:
    """Rows (kind, a, b) from runs of equal signatures: pairs of the first member, and (``MEMBER``, name, node) of runs of three and more.

    Near copies share many signatures, so the same members come again and again: a run of up to ``RUN`` members is
    named by its list, and comes once in a while of a task; a longer one is named by its signature.

    Rows come sorted by signature and node; a run is never held beyond ``RUN`` rows and a batch.
    """

    def pairs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)]
        long_run: tuple[int, int, int] | None = None  # signature, first node and its size
        told: set[int] = set()  # names of member lists

        def fits(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            return 100 * np.minimum(x, y).astype(np.int64) >= threshold * np.maximum(x, y).astype(np.int64)

        def members(signature: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
            return _kind_batch(MEMBER, signature, nodes)

        def work(sig: np.ndarray, node: np.ndarray, size: np.ndarray, final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal carry, long_run
            new = np.concatenate([[True], (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])])
            sig, node, size = sig[new], node[new], size[new]
            first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
            length = np.diff(np.append(first, len(sig)))
            lefts, rights = [], []
            open_long = not final and length[-1] > RUN
            if not final and not open_long:  # the last run may go on
                carry = [x[first[-1] :] for x in (sig, node, size)]
                first, length = first[:-1], length[:-1]
            else:
                carry = [x[:0] for x in (sig, node, size)]
            for n in np.unique(length[(length > 1) & (length <= RUN)]).tolist():
                at = first[length == n][:, None] + np.arange(n)
                if long_run is not None and sig[at[0, 0]] == long_run[0]:
                    at = at[1:]
                names, one = np.unique(_list_names(node[at]), return_index=True)
                new = np.array([x not in told for x in names.tolist()], bool)
                names, at = names[new], at[one[new]]
                told.update(names.tolist())
                ok = fits(size[at[:, :1]], size[at[:, 1:]])
                lefts.append(np.broadcast_to(node[at[:, :1]], ok.shape)[ok])
                rights.append(node[at[:, 1:]][ok])
                if n > 2 and len(at):
                    yield members(np.repeat(names, n), node[at.ravel()])
            if len(told) > TOLD:
                told.clear()
            for k in np.flatnonzero((length > RUN) | (sig[first] == (long_run[0] if long_run else 0)) & (long_run is not None)).tolist():
                run = slice(first[k], first[k] + length[k])
                if long_run is None or long_run[0] != sig[first[k]]:
                    long_run = (int(sig[first[k]]), int(node[first[k]]), int(size[first[k]]))
                others = node[run] != long_run[1]
                ok = others & fits(size[run], np.full(length[k], long_run[2]))
                lefts.append(node[run][ok])
                rights.append(np.full(int(ok.sum()), long_run[1]))
                yield members(sig[run], node[run])
            if lefts:
                yield _pair_batch(FIRST, lefts, rights)

        for batch in batches:
            columns = [np.concatenate([c, batch.column(i).to_numpy()]) for i, c in enumerate(carry)]
            if len(columns[0]):
                yield from work(*columns, final=False)
        if len(carry[0]):
            yield from work(*carry, final=True)

    sorted_rows = signed.repartition("signature").sortWithinPartitions("signature", "node")
    return sorted_rows.mapInArrow(pairs_of, "kind int, a long, b long")


def _near(pairs: DataFrame, nodes: DataFrame, threshold: int) -> DataFrame:
    """Pairs that their sizes and sketches do not rule out."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = np.array([sketch_distance(x, y) for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist(), strict=True)], np.int64)
            total = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
            near = apart <= total * (100 - threshold) // (100 + threshold)
            yield batch.select(["a", "b"]).filter(pa.array(near))

    one = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    two = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    return pairs.join(one, "a").join(two, "b").mapInArrow(keep, "a long, b long")


def _distances(sketches: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``sketch_distance`` of many pairs (i, j) of a list."""
    length = np.array([len(x) for x in sketches])
    out = np.zeros(len(i), np.int64)
    place = np.zeros(len(sketches), np.int64)
    tables = {}
    for n in np.unique(length).tolist():
        at = np.flatnonzero(length == n)
        place[at] = np.arange(len(at))
        tables[n] = np.stack([sketches[k] for k in at.tolist()])
    finer, coarser = np.maximum(length[i], length[j]), np.minimum(length[i], length[j])
    for high, low in np.unique(np.stack([finer, coarser], axis=1), axis=0).tolist():
        at = np.flatnonzero((finer == high) & (coarser == low))
        swap = length[i[at]] == high
        x, y = np.where(swap, i[at], j[at]), np.where(swap, j[at], i[at])
        fine = tables[high]
        if high > low:
            fine = np.minimum(fine.reshape(len(fine), -1, low).sum(axis=1, dtype=np.int32), 255).astype(np.uint8)
        step = max(1, (4 << 20) // low)
        for k in range(0, len(at), step):
            one, two = fine[place[x[k : k + step]]].astype(np.int16), tables[low][place[y[k : k + step]]].astype(np.int16)
            out[at[k : k + step]] = np.abs(one - two).sum(axis=1, dtype=np.int64)
    return out


def _compared(held: DataFrame, threshold: int) -> DataFrame:
    """Near pairs between different components within the runs: rows (``OTHER``, a, b).

    Runs that are too long for one task, or have too many such pairs, come back as they are: rows (``MEMBER``, signature, node).
    """

    def near_pairs(node: np.ndarray, label: np.ndarray, size: np.ndarray, sketches: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray] | None:
        found, n, listed = [], len(node), 0
        step = max(1, (1 << 18) // n)
        for low in range(0, n, step):
            i, j = np.nonzero(
                (label[low : low + step, None] != label)
                & (100 * np.minimum(size[low : low + step, None], size) >= threshold * np.maximum(size[low : low + step, None], size))
                & (np.arange(low, min(low + step, n))[:, None] < np.arange(n))
            )
            i += low
            near = _distances(sketches, i, j) <= (size[i] + size[j]) * (100 - threshold) // (100 + threshold)
            found.append((node[i[near]], node[j[near]]))
            listed += int(near.sum())
            if listed > LISTED * n:
                return None
        return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])

    def short_runs(first: np.ndarray, length: np.ndarray, node: np.ndarray, label: np.ndarray, size: np.ndarray, sketches: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        lefts, rights = [], []
        for n in np.unique(length).tolist():
            at = first[length == n][:, None] + np.arange(n)
            i, j = np.triu_indices(n, 1)
            lefts.append(at[:, i].ravel())
            rights.append(at[:, j].ravel())
        if lefts:
            i, j = np.concatenate(lefts), np.concatenate(rights)
            may = (label[i] != label[j]) & (100 * np.minimum(size[i], size[j]) >= threshold * np.maximum(size[i], size[j]))
            i, j = i[may], j[may]
            near = _distances(sketches, i, j) <= (size[i] + size[j]) * (100 - threshold) // (100 + threshold)
            if near.any():
                yield _pair_batch(OTHER, [node[i[near]]], [node[j[near]]])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # of the run that may go on
        beyond = None  # signature of a run that is too long

        def work(table: pa.Table, final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal beyond
            sig, node, label, size = (table.column(c).to_numpy().astype(np.int64) for c in ("signature", "node", "label", "n"))
            first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
            length = np.diff(np.append(first, len(sig)))
            if beyond is not None and sig[0] == beyond:
                yield _kind_batch(MEMBER, sig[: length[0]], node[: length[0]])
                first, length = first[1:], length[1:]
            done = len(first) if final else max(len(first) - 1, 0)
            held.clear()
            if done < len(first):
                rest = table.slice(first[-1])
                if len(rest) <= COMPARED and pc.sum(pc.binary_length(rest.column("sketch"))).as_py() <= SKETCHED:
                    held.extend(rest.to_batches())
                else:
                    beyond = int(sig[-1])
                    yield _kind_batch(MEMBER, sig[first[-1] :], node[first[-1] :])
            if done:
                sketches = [np.frombuffer(x.as_buffer(), np.uint8) for chunk in table.column("sketch").chunks for x in chunk]
                few = length[:done] <= RUN
                yield from short_runs(first[:done][few], length[:done][few], node, label, size, sketches)
                for low, n in zip(first[:done][~few].tolist(), length[:done][~few].tolist(), strict=True):
                    run = slice(low, low + n)
                    pairs = near_pairs(node[run], label[run], size[run], sketches[run])
                    if pairs is None:
                        yield _kind_batch(MEMBER, sig[run], node[run])
                    elif len(pairs[0]):
                        yield _pair_batch(OTHER, [pairs[0]], [pairs[1]])

        for batch in rows_of(batches, COMPARED):
            if batch.num_rows:
                yield from work(pa.Table.from_batches([*held, batch]), final=False)
        if held:
            yield from work(pa.Table.from_batches(held), final=True)

    sorted_rows = held.repartition("signature").sortWithinPartitions("signature", "node")
    return sorted_rows.mapInArrow(compare, "kind int, a long, b long")


def _pack(shingles: np.ndarray) -> bytes:
    """The 40 highest bits of every shingle: two sets of a thousand shingles take one for another once in a million pairs."""
    raw = (shingles >> np.uint64(24)).astype("<u8")
    return raw.view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return wide.view("<u8").ravel()


def _owners(source: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of which one at least holds each set: those with the least id of a set.

    The shorter list, of ids that are needed or of those that are not, goes to all tasks; if it is long, all rows are taken.
    """
    needed = nodes.select("id").distinct()
    spare = settle(docs.where("id is not null").select("id").distinct().join(needed, "id", "left_anti"), "spare")
    n_needed, n_spare = nodes.count(), spare.count()
    if min(n_needed, n_spare) > WANTED:
        return source
    if n_needed < n_spare:
        return source.join(F.broadcast(needed), source["id"].eqNullSafe(needed["id"]), "left_semi")
    return source.join(F.broadcast(spare), source["id"] == spare["id"], "left_anti")


def _sets(source: DataFrame, words: int, wanted: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, packed set) of the wanted nodes, each once.

    While the list of wanted nodes is short, it goes to all tasks and so do the ids of a text of each, so that
    only those texts are looked at; else the sets of all texts are joined by a shuffle.
    """

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in rows_of(batches):
            found, packed = [], []
            for s in shingle_sets(batch.column("text").to_pylist(), words):
                node = set_hash(s) if len(s) else None
                if node is not None and node not in seen:
                    seen.add(node)
                    found.append(node)
                    packed.append(_pack(s))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(packed, pa.binary())], names=["node", "set"])

    wanted = settle(wanted.distinct(), "wanted")
    short = wanted.count() <= WANTED
    if short:
        ids = settle(nodes.join(F.broadcast(wanted), "node", "left_semi").select("id").distinct(), "ids")
        source = source.join(F.broadcast(ids), source["id"].eqNullSafe(ids["id"]), "left_semi")
    found = source.select("text").mapInArrow(collect, "node long, set binary").join(F.broadcast(wanted) if short else wanted, "node", "left_semi")
    return settle(found.groupBy("node").agg(F.first("set").alias("set")), "sets")


def _verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 2048):
            keep = []
            for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist(), strict=True):
                x, y = _unpack(x), _unpack(y)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= threshold * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("node").alias("a"), F.col("set").alias("sa"))
    two = sets.select(F.col("node").alias("b"), F.col("set").alias("sb"))
    return pairs.join(one, "a").join(two, "b").mapInArrow(link, "a long, b long")


def _overlaps(rows: list[np.ndarray], columns: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all sets of one list with all of another, by products of 0-1 matrices."""
    x, y = np.concatenate(rows), np.concatenate(columns)
    shared = np.intersect1d(x, y)
    out = np.zeros((len(rows), len(columns)), np.float32)
    for low in range(0, len(shared), width):
        part = shared[low : low + width]
        sides = []
        for sets in (rows, columns):
            m = np.zeros((len(sets), len(part)), np.float32)
            for i, s in enumerate(sets):
                at = np.searchsorted(part, s)
                at[at == len(part)] = 0
                m[i, at[part[at] == s]] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return out


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the graph."""
    above: dict[int, int] = {}

    def root(x: int) -> int:
        while above.get(x, x) != x:
            above[x] = x = above.get(above[x], above[x])
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        rx, ry = root(x), root(y)
        if rx != ry:
            above[rx] = ry
            kept.append((x, y))
    return kept


def _tagged(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(signature, node, label) of members, the label being the component, or the node itself."""
    label = F.coalesce("component", members["node"]).alias("label")
    return settle(members.join(labels, members["node"] == labels["node"], "left").select("signature", members["node"], label), "members")


def _mixed(tagged: DataFrame) -> DataFrame:
    """(signature, head) of the runs that hold several components."""
    return tagged.groupBy("signature").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min("node").alias("head")).where("low < high").drop("low", "high")


def _family_links(source: DataFrame, words: int, members: DataFrame, nodes: DataFrame, labels: DataFrame, threshold: int) -> DataFrame:
    """Links within long runs that the pairs listed before have not shown."""
    tagged = _tagged(members, labels)
    held = tagged.join(_mixed(tagged).select("signature", "head"), "signature")
    edges = settle(held.select(F.col("head").alias("a"), F.col("node").alias("b")).distinct(), "families")
    families = connected_components(edges).withColumnRenamed("component", "family")
    label_of = tagged.select("node", "label").distinct()
    rows = families.join(label_of, "node").join(nodes.select("node", "n"), "node")
    # Blocks of a bounded number of rows: large components of a family have blocks of their own, so that few blocks need comparing.
    size_of = rows.groupBy("family", "label").agg(F.count("*").alias("members"))
    part = F.when(F.col("members") >= BLOCK, F.col("label")).otherwise(0).alias("part")
    parts = size_of.select("family", "label", part, "members")
    pieces = parts.groupBy("family", "part").agg(F.ceil(F.sum("members") / F.lit(BLOCK)).alias("pieces"))
    cut = rows.join(parts.drop("members"), ["family", "label"]).join(pieces, ["family", "part"])
    place = F.xxhash64("part", F.pmod(F.xxhash64("node"), F.col("pieces")))
    blocks = settle(cut.select("family", "node", "label", "n", place.alias("block")), "blocks")
    about = blocks.groupBy("family", "block").agg(*(f(c).alias(f"{c}_{e}") for c in ("label", "n") for f, e in ((F.min, "low"), (F.max, "high"))))
    x, y = about.alias("x"), about.alias("y")
    one_component = (F.col("x.label_low") == F.col("x.label_high")) & (F.col("y.label_low") == F.col("y.label_high")) & (F.col("x.label_low") == F.col("y.label_low"))
    sizes_meet = (100 * F.col("x.n_high") >= threshold * F.col("y.n_low")) & (100 * F.col("y.n_high") >= threshold * F.col("x.n_low"))
    due = x.join(y, (F.col("x.family") == F.col("y.family")) & (F.col("x.block") <= F.col("y.block")) & ~one_component & sizes_meet)
    due = settle(due.select(F.col("x.family").alias("family"), F.col("x.block").alias("one"), F.col("y.block").alias("two")), "due")
    ends = due.select("family", "one", "two", F.col("one").alias("block")).unionByName(due.select("family", "one", "two", F.col("two").alias("block")).where("one < two"))
    met = ends.join(blocks, ["family", "block"])
    dealt = met.join(_sets(source, words, met.select("node"), nodes), "node")

    def compare(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        sides = [frame[frame["block"] == k] for k in key[1:]]
        one, two = ([_unpack(s) for s in side["set"]] for side in sides)
        out = pd.DataFrame({"a": pd.Series([], dtype="int64"), "b": pd.Series([], dtype="int64")})
        if one and two:
            both = _overlaps(one, two).astype(np.int64)
            total = np.add.outer([len(s) for s in one], [len(s) for s in two])
            linked = 100 * both >= threshold * (total - both)
            linked &= sides[0]["label"].to_numpy()[:, None] != sides[1]["label"].to_numpy()[None, :]
            i, j = np.nonzero(linked)
            found = _forest(sides[0]["node"].to_numpy()[i], sides[1]["node"].to_numpy()[j])
            out = pd.DataFrame(found, columns=["a", "b"]).astype("int64")
        return out

    return dealt.groupBy("family", "one", "two").applyInPandas(compare, "a long, b long")


def ngram_join(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """Per row its id, the size of its shingle set, and the smallest id reachable by links."""
    spark = df.sparkSession
    with setting(spark, CLEANUP, "true"):
        return _joined(df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")), words, threshold, id_column)


def _joined(source: DataFrame, words: int, threshold: int, id_column: str) -> DataFrame:
    spark = source.sparkSession
    profiles = settle(_profiles(source, words), "profiles")
    common = spark.sparkContext.broadcast(_common(profiles))
    docs = profiles.where("not counted")
    firsts = (F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min("id").alias("id"))
    nodes = settle(docs.where("node is not null").groupBy("node").agg(*firsts), "nodes")

    runs = settle(_runs(_signed(_owners(source, docs, nodes).select("text"), words, common, threshold), threshold), "runs")

    def linked(near: DataFrame) -> DataFrame:
        ends = near.select(F.col("a").alias("node")).unionByName(near.select(F.col("b").alias("node")))
        return settle(_verified(near, _sets(source, words, ends, nodes), threshold), "links")

    links = linked(settle(_near(runs.where(F.col("kind") == FIRST).select("a", "b").distinct(), nodes, threshold), "near"))
    members = runs.where(F.col("kind") == MEMBER).select(F.col("a").alias("signature"), F.col("b").alias("node")).distinct()
    if not members.isEmpty():
        labels = settle(connected_components(links), "labels")
        tagged = _tagged(members, labels)
        held = tagged.join(_mixed(tagged).select("signature"), "signature").join(nodes.select("node", "n", "sketch"), "node")
        compared = settle(_compared(held, threshold), "compared")
        others = compared.where(F.col("kind") == OTHER).select("a", "b").distinct()
        if not others.isEmpty():
            links = links.unionByName(linked(settle(others, "near")))
        members = compared.where(F.col("kind") == MEMBER).select(F.col("a").alias("signature"), F.col("b").alias("node"))
        if not members.isEmpty():
            labels = settle(connected_components(links), "labels")
            links = links.unionByName(settle(_family_links(source, words, members, nodes, labels, threshold), "links"))

    # Rows with one id and different texts tie their sets together, as the id does.
    shared = docs.where("node is not null and id is not null").groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b")
    tied = docs.join(shared.select("id", "a"), "id").where("node is not null").select("a", F.col("node").alias("b"))
    labels = connected_components(links.unionByName(tied))
    named = docs.join(labels, "node", "left").select("id", "n", F.coalesce("component", "node").alias("component"))
    named = settle(named, "named")
    least = named.where("component is not null").groupBy("component").agg(F.min("id").alias("least"))
    out = named.join(least, "component", "left")
    alone = F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("least"))
    return out.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), alone.alias("component_id"))
