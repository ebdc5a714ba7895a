"""Nearest neighbours against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import curves

SCHEMA = "vec_id long, embedding array<float>, entry long, curve int"


def _df(spark, vectors):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in vectors], SCHEMA)


def _brute(vectors, query_ids, k):
    ok = {i: np.array(v, np.float64) for i, v in vectors if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for q in query_ids:
        if q in ok:
            scores = sorted((-float((ok[q] * x).sum()), i) for i, x in ok.items() if i != q)
            out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def _found(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_odd_vectors_and_copies(spark, odd):
    rnd = np.random.default_rng(1)
    vectors = [(i, np.float32(rnd.normal(size=4)).tolist()) for i in range(60)]
    vectors += [(100 + i, vectors[3][1]) for i in range(40)]  # copies: ties go to the smaller id
    vectors += [(200, None), (220, [0.0] * 4), (240, [1.0, None, 1.0, 1.0]), (260, [1.0, math.nan, 1.0, 1.0]), (280, [math.inf, 1.0, 1.0, 1.0]), (300, [1.0]), (None, [1.0] * 4)]
    found = _found(curves.nearest(_df(spark, vectors), F.col("vec_id") % 20 == 0, k=7).collect())
    wanted = _brute([v for v in vectors if v[0] != 300], [i for i, _ in vectors if i is not None and i % 20 == 0], 7)
    assert found.keys() == wanted.keys()
    for q in wanted:
        assert [i for i, _ in found[q]] == [i for i, _ in wanted[q]]
        assert [s for _, s in found[q]] == pytest.approx([s for _, s in wanted[q]], abs=1e-12)


def test_few_and_none(spark):
    two = _df(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0])])
    assert [(r["vec_id"], r["rank"]) for r in curves.nearest(two, F.col("vec_id") % 20 == 0).collect()] == [(1, 1)]
    assert curves.nearest(_df(spark, []), F.col("vec_id") % 20 == 0).count() == 0


def test_recall(spark, odd):
    """Windows narrower than the table, on vectors of different lengths."""
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(3000, 64)) * rnd.uniform(0.5, 1.5, size=(3000, 1))
    vectors = [(i, v) for i, v in enumerate(x.astype(np.float32).tolist())]
    found = _found(curves.nearest(_df(spark, vectors), F.col("vec_id") % 100 == 0, window=256, curves=12).collect())
    wanted = _brute(vectors, range(0, 3000, 100), 20)
    recall = np.mean([len({i for i, _ in found[q]} & {i for i, _ in wanted[q]}) / 20 for q in wanted])
    assert recall >= 0.9


@pytest.mark.parametrize("block", [curves.BLOCK, 50])
def test_candidates_follow_the_table(spark, odd, block):
    """Vectors of one length without structure, many times more than the least windows of all curves hold."""
    rnd = np.random.default_rng(6)
    x = rnd.normal(size=(6000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    vectors = [(i, v) for i, v in enumerate(x.astype(np.float32).tolist())]
    found = _found(curves.nearest(_df(spark, vectors), F.col("vec_id") % 200 == 0, window=8, block=block).collect())
    wanted = _brute(vectors, range(0, 6000, 200), 20)
    recall = np.mean([len({i for i, _ in found[q]} & {i for i, _ in wanted[q]}) / 20 for q in wanted])
    assert recall >= 0.9


def test_hilbert_keys_visit_neighbours():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.array(np.meshgrid(*[range(1 << bits)] * dims)).reshape(dims, -1).T
        keys = curves.hilbert_keys(cells, bits)
        path = cells[np.argsort(keys)]
        assert sorted(keys) == list(range(len(cells)))
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()
