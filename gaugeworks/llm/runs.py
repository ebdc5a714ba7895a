"""Periodic runs of words, by a suffix automaton with link-cut access.

The suffix links of a text's automaton form a tree; the path from a prefix's state to the
root holds all its suffixes. Each state is coloured by the end of its last occurrence so far.
Appending word ``i`` accesses the state of that prefix: the path to the root falls into
segments of one colour, which a link-cut tree keeps as preferred paths. A segment whose
suffixes ended last at ``e`` and reach a length of at least ``i - e`` shows a square of period
``i - e``; its longest suffix says where the repetition starts, and the last word that shows
it is where the run ends. Then the whole path takes the colour ``i``.

Only words that can lie in a run get there: a run of at least 24 words and three periods holds
no sequence of ``GRAM`` words that its text has only once, so texts are cut into stretches
whose sequences all repeat, found for many texts at once by sorting hashes (a collision makes
a stretch longer, never shorter). A run lies in one stretch, and is a run of it.

Rows are texts and no row is shuffled, so no key can gather rows. A task holds the words of
``rows_of`` texts and the automaton of one stretch, about a kilobyte a word of it.

Defined results: a null text counts as empty; an empty one has no run and collapses to the
empty text; repeated rows, null and repeated ids are rows of their own; an empty table gives
an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Hashable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.tables import rows_of

#: A run has at least so many words, and so many periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: A run of period q holds 2q + GRAM - 1 words or more, so that each of its sequences of GRAM words occurs a period before or after.
GRAM = 8
_FACTOR = np.uint64(0x9E37_79B9_7F4A_7C15)


def _automaton(words: Sequence[Hashable]) -> tuple[list[int], list[int], list[int]]:
    """Length of the longest suffix and suffix link of every state, and the state of every prefix; state 0 is the empty suffix."""
    step: list[dict] = [{}]
    length, link, prefixes = [0], [-1], []
    last = 0
    for word in words:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and word not in step[at]:
            step[at][word] = new
            at = link[at]
        if at >= 0:
            to = step[at][word]
            if length[to] > length[at] + 1:  # only its shorter suffixes end here: they become a state of their own
                part = len(step)
                step.append(step[to].copy())
                length.append(length[at] + 1)
                link.append(link[to])
                while at >= 0 and step[at].get(word) == to:
                    step[at][word] = part
                    at = link[at]
                link[to] = part
                to = part
            link[new] = to
        last = new
        prefixes.append(new)
    return length, link, prefixes


class _LastOccurrences:
    """The tree of suffix links as preferred paths, one per colour, each a splay tree by depth.

    State 0 stands for no state. The colour of a path is kept at the root of its splay tree.
    """

    def __init__(self, length: list[int], link: list[int]):
        self.length = length
        self.up = link[:]  # in a splay tree its parent, at its root the state above the path
        self.up[0] = 0
        self.left, self.right = [0] * len(link), [0] * len(link)
        self.colour = [-1] * len(link)

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        parent = up[x]
        above = up[parent]
        if left[parent] == x:
            inner = left[parent] = right[x]
            right[x] = parent
        else:
            inner = right[parent] = left[x]
            left[x] = parent
        if inner:
            up[inner] = parent
        up[parent], up[x] = x, above
        if above:
            if left[above] == parent:
                left[above] = x
            elif right[above] == parent:
                right[above] = x

    def _splay(self, x: int) -> None:
        up, left, right, colour = self.up, self.left, self.right, self.colour
        parent = up[x]
        while parent and (left[parent] == x or right[parent] == x):
            above = up[parent]
            if above and (left[above] == parent or right[above] == parent):
                self._rotate(parent if (left[above] == parent) == (left[parent] == x) else x)
                colour[x] = colour[above]
            else:
                colour[x] = colour[parent]
            self._rotate(x)
            parent = up[x]

    def access(self, state: int, end: int) -> Iterator[tuple[int, int]]:
        """(end of the last occurrence, longest suffix) of each segment on the way to the root, which then all end last at ``end``."""
        right, up, colour = self.right, self.up, self.colour
        below, x = 0, state
        while x:
            self._splay(x)
            if colour[x] >= 0:
                yield colour[x], self.length[x]
            if right[x]:
                colour[right[x]] = colour[x]
            right[x] = below
            below, x = x, up[x]
        self._splay(state)
        colour[state] = end


def runs_in(words: Sequence[Hashable]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period."""
    length, link, prefixes = _automaton(words)
    tree = _LastOccurrences(length, link)
    ends: dict[tuple[int, int], int] = {}
    for i, state in enumerate(prefixes):
        for last, suffix in tree.access(state, i):
            period = i - last
            if suffix >= (LEAST_PERIODS - 1) * period and suffix + period >= LEAST_WORDS:
                ends[last - suffix + 1, period] = i
    return sorted((start, end - start + 1, period) for (start, period), end in ends.items())


def _stretches(texts: list[list[bytes]]) -> list[list[tuple[int, int]]]:
    """Per text the bounds of its longest parts in which every sequence of GRAM words occurs twice in the text."""
    sizes = np.array([len(words) for words in texts])
    total = int(sizes.sum())
    found: list[list[tuple[int, int]]] = [[] for _ in texts]
    if total < LEAST_WORDS:
        return found
    ends = np.cumsum(sizes)
    text = np.repeat(np.arange(len(texts)), sizes)
    hashes = np.fromiter((h for words in texts for h in map(hash, words)), np.int64, total).view(np.uint64)
    n = total - GRAM + 1
    key = text[:n].astype(np.uint64)
    for k in range(GRAM):
        key = key * _FACTOR + hashes[k : k + n]
    key ^= key >> np.uint64(32)
    inside = text[:n] == text[GRAM - 1 :]
    in_order = np.sort(key[inside])
    twice = np.unique(in_order[1:][in_order[1:] == in_order[:-1]])
    if not len(twice):
        return found
    spot = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
    repeated = (twice[spot] == key) & inside
    edges = np.flatnonzero(np.diff(np.concatenate(([False], repeated, [False]))))
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        if b - a + GRAM - 1 >= LEAST_WORDS:
            t = int(text[a])
            start = int(ends[t] - sizes[t])
            found[t].append((a - start, b + GRAM - 1 - start))
    return found


def text_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of every text."""
    return [
        [(a + start, length, period) for a, b in bounds for start, length, period in runs_in(words[a:b])]
        for words, bounds in zip(texts, _stretches(texts), strict=True)
    ]


def _kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that are in no run after its first period."""
    if not runs:
        return words
    dropped = np.zeros(len(words), bool)
    for start, length, period in runs:
        dropped[start + period : start + length] = True
    return [words[i] for i in np.flatnonzero(~dropped)]


def collapse(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_words, runs, collapsed) of every row.

    ``runs`` are all runs by start and period; ``collapsed`` is the text's words, joined by
    one space, less those that any run holds after its first period. Words are what lies
    between blanks, tabs and line ends.
    """
    source = df.select(F.col(id_column), F.coalesce(F.col(text_column), F.lit("")).alias("__text"))
    run_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            texts = [t.split() for t in batch.column(1).cast(pa.binary()).to_pylist()]
            runs = text_runs(texts)
            collapsed = pa.array([b" ".join(_kept(*x)) for x in zip(texts, runs, strict=True)], pa.binary()).view(pa.string())
            named = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in rs] for rs in runs]
            columns = [batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array(named, run_type), collapsed]
            yield pa.RecordBatch.from_arrays(columns, names=[id_column, "n_words", "runs", "collapsed"])

    kind = dict(source.dtypes)[id_column]
    return source.mapInArrow(find, f"`{id_column}` {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def strongest(runs: Column) -> Column:
    """The run of most periods, the first of equal ones; null if there is none."""
    more = lambda best, r: r["length"] * best["period"] > best["length"] * r["period"]
    return F.aggregate(runs, F.try_element_at(runs, F.lit(1)), lambda best, r: F.when(more(best, r), r).otherwise(best))
