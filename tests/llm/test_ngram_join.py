"""Signatures lose no link, and components equal those of a join of all pairs."""

import random
import re

import numpy as np
import pytest

from gaugeworks.llm import ngram_join as nj
from gaugeworks.llm.components import connected_components
from gaugeworks.llm.shingles import set_hash, shingle_sets
from tests.llm.conftest import ROWS


def _set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset([tuple(words)] if 0 < len(words) < 5 else (tuple(words[i : i + 5]) for i in range(len(words) - 4)))


def _components(rows):
    """Smallest id reachable per distinct (id, text), rows of one id being tied."""
    sets = [_set(t) for _, t in rows]
    above = list(range(len(rows)))

    def root(k):
        while above[k] != k:
            k = above[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            same_id = rows[i][0] is not None and rows[i][0] == rows[j][0] and sets[i] and sets[j]
            if same_id or sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j]):
                above[root(i)] = root(j)
    out = []
    for i, (name, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((name, len(sets[i]), min(ids) if sets[i] and ids else name if not sets[i] else None))
    return sorted(map(repr, out))


def _near_copies(seed=4):
    rnd = random.Random(seed)
    rows = []
    for g in range(25):
        base = [f"w{rnd.randint(0, 400)}" for _ in range(rnd.choice([3, 6, 9, 14, 40, 120]))]
        for _ in range(rnd.randint(1, 12)):
            copy = list(base)
            for _ in range(rnd.randint(0, max(1, len(base) // 25))):
                copy[rnd.randrange(len(copy))] = f"w{rnd.randint(0, 400)}"
            if rnd.random() < 0.3:
                copy += "a passage that many documents share word for word as a licence line".split()
            rows.append((len(rows) * 3 % 1000, " ".join(copy)))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize(("run", "block"), [(32, 512), (2, 4)])
def test_components(spark, odd, monkeypatch, run, block):
    monkeypatch.setattr(nj, "RUN", run)
    monkeypatch.setattr(nj, "BLOCK", block)
    rows = _near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(map(repr, map(tuple, nj.ngram_join(df).collect()))) == _components(rows)


def test_odd_rows(odd, empty):
    assert sorted(map(repr, map(tuple, nj.ngram_join(odd).collect()))) == _components(ROWS)
    assert nj.ngram_join(empty).count() == 0


def test_similar_sets_share_a_signature():
    """Pairs just at the threshold, over all small sizes and some large ones."""
    rnd = np.random.default_rng(8)
    none = np.empty(0, np.uint64), np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        for size in [*range(1, 40), 63, 64, 65, 200, 255, 256, 300, 1000, 1024]:
            for extra in {0, size // 7, size // 3}:
                base = rnd.integers(0, 2**63, size, dtype=np.uint64)
                # As few shared shingles as the threshold allows for b = size + extra.
                shared = -(-75 * (2 * size + extra) // 175)
                if shared > size:
                    continue
                other = np.concatenate([base[:shared], rnd.integers(0, 2**63, size + extra - shared, dtype=np.uint64)])
                left, right = (nj.signatures(np.sort(s), *none) for s in (base, other))
                assert np.intersect1d(left, right).size, (size, extra)


def test_sketches_never_rule_out_a_link():
    rnd = np.random.default_rng(9)
    for size in (3, 60, 255, 257, 1020, 1030, 5000):
        for _ in range(30):
            a = rnd.integers(0, 2**63, size, dtype=np.uint64)
            b = np.concatenate([a[: rnd.integers(size // 2, size + 1)], rnd.integers(0, 2**63, rnd.integers(0, size), dtype=np.uint64)])
            assert nj.sketch_distance(nj.sketch(a), nj.sketch(b)) <= len(np.setxor1d(a, b))


def test_shingles_equal_words():
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(["a", "B", "b", "É", " ", "\n", "\t\t", "\x1c", "\xa0", "cc"]) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    names = {}
    for text, s in zip(texts, shingle_sets(texts), strict=True):
        assert len(s) == len(_set(text))
        assert names.setdefault(_set(text), set_hash(s)) == set_hash(s)
    assert len(set(names.values())) == len(names)


def test_connected_components(spark):
    rnd = random.Random(6)
    edges = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, 5001 + i) for i in range(50)] + [(7, 7), (None, 3)]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    above = {}

    def root(x):
        while above.get(x, x) != x:
            x = above[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = root(a), root(b)
            above[max(x, y)] = min(x, y)
    nodes = {x for a, b in edges if a is not None and a != b for x in (a, b)}
    assert found == {x: root(x) for x in nodes}
