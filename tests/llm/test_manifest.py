"""Merkle manifest against a tree built in plain Python."""

import hashlib

import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import manifest
from gaugeworks.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import same_as_sql


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(*values):
    return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _levels(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        d = levels[-1]
        levels.append([_h(*d[i : i + 2]) for i in range(0, len(d), 2)])
    return levels


def _siblings(levels, i):
    return [(d[i >> k ^ 1] if (i >> k ^ 1) < len(d) else "", bool((i >> k) & 1)) for k, d in enumerate(levels[:-1])]


def _wanted(rows):
    """Sorted (id, leaf, subroot, root, proof digest) of rows (id, part, text)."""
    parts = sorted({p for _, p, _ in rows}, key=lambda p: (p is not None, (p or "").encode()))
    of = {p: _levels([_leaf(i, p, t) for i, _, t in sorted((r for r in rows if r[1] == p), key=lambda r: (r[0] is not None, r[0] or 0, _leaf(*r)))]) for p in parts}
    top = _levels([of[p][-1][0] for p in parts])
    out = []
    for k, p in enumerate(parts):
        ids = sorted((r for r in rows if r[1] == p), key=lambda r: (r[0] is not None, r[0] or 0, _leaf(*r)))
        for i, row in enumerate(ids):
            path = _siblings(of[p], i) + _siblings(top, k)
            out.append((row[0], _leaf(*row), of[p][-1][0], top[-1][0], _h(*(s for s, _ in path))))
    return sorted(map(repr, out))


ODD = [
    (1, "en", "a"), (1, "en", "a"), (1, "en", "b"), (None, "en", None), (None, "en", ""), (2**62, "en", "far"), (-3, "en", "x" * 100_000),
    (5, None, "no part"), (6, "", "empty part"), (7, "é", "é"), (8, "zz", "last"), (9, "zz", "last"), (10, "zz", None),
]


@pytest.mark.parametrize("height", [2, 10])
@pytest.mark.parametrize("rows", [ODD, [(i // 3, "en" if i % 5 else f"l{i % 7}", f"t{i % 11}") for i in range(333)], [(4, "one", "leaf")]], ids=["odd", "many", "one"])
def test_proofs(spark, monkeypatch, rows, height):
    monkeypatch.setattr(manifest, "HEIGHT", height)
    monkeypatch.setattr(manifest, "WIDTH", 2**height)
    df = spark.createDataFrame([(*r, "clash", 9) for r in rows], "doc_id long, lang string, text string, lo string, n int").repartition(5)
    df = df.withColumn("leaf", manifest.leaf_digest(F.col("doc_id"), F.col("lang"), F.col("text")))
    built = manifest.build(df, F.col("lang"), ["doc_id"], ["doc_id", "leaf"])
    path = F.col("path")
    found = built.proofs().select("held.*", "subroot", "root", manifest.path_digest(path), manifest.folded(path, F.col("held.leaf")).alias("folded")).collect()
    assert sorted(repr(tuple(r)[:5]) for r in found) == _wanted(rows)
    assert all(r["folded"] == r["root"] for r in found)


def test_nodes_carry_the_intervals_of_their_leaves(spark, monkeypatch):
    monkeypatch.setattr(manifest, "HEIGHT", 2)
    monkeypatch.setattr(manifest, "WIDTH", 4)
    df = spark.range(37).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 21, "a").otherwise("b").alias("lang")).withColumn("leaf", manifest.leaf_digest(F.col("doc_id")))
    nodes = manifest.build(df, F.col("lang"), ["doc_id"], ["doc_id"]).nodes().collect()
    digest = {(r["tree"], r["part"], r["level"], r["lo"], r["hi"]): r["digest"] for r in nodes}
    assert len(digest) == len(nodes)
    wanted = {}
    for part, ids in (("=a", range(21)), ("=b", range(21, 37))):
        levels = _levels([_leaf(i) for i in ids])
        for k, level in enumerate(levels):
            wanted |= {("part", part, k, j << k, min(len(ids), (j + 1) << k)): d for j, d in enumerate(level)}
        wanted["whole", "", 0, part == "=b", (part == "=b") + 1] = levels[-1][0]
    wanted["whole", "", 1, 0, 2] = _h(wanted["whole", "", 0, 0, 1], wanted["whole", "", 0, 1, 2])
    assert digest == wanted


def test_ranks_do_not_follow_the_partitions(spark):
    df = spark.createDataFrame([("p" if i % 3 else "q", (i * 37) % 101, i) for i in range(500)], "part string, x int, n string").repartition(6)
    found = manifest.ranked(df.drop("n"), "part", ["x"]).collect()
    for part in "pq":
        own = sorted((r["lo"], r["x"], r["n"]) for r in found if r["part"] == part)
        assert [r[0] for r in own] == list(range(len(own))) and [r[1] for r in own] == sorted(r[1] for r in own)
        assert {r[2] for r in own} == {len(own)}


def test_tampering_shows(spark):
    df = spark.createDataFrame([(i, "en", f"t{i}") for i in range(50)], "doc_id long, lang string, text string")
    df = df.withColumn("leaf", manifest.leaf_digest(F.col("text")))
    proofs = manifest.build(df, F.col("lang"), ["doc_id"], ["doc_id", "leaf"]).proofs()
    wrong = F.when(F.col("held.doc_id") == 7, "bad").otherwise(F.col("held.leaf"))
    bad = proofs.where(manifest.folded(F.col("path"), wrong) != F.col("root")).select("held.doc_id").collect()
    assert [r[0] for r in bad] == [7]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, lang string, leaf string")
    built = manifest.build(df, F.col("lang"), ["doc_id"], ["doc_id"])
    assert built.proofs().count() == 0 and built.nodes().count() == 0


def test_query_equals_sql(spark):
    same_as_sql(spark, QUERIES["op11_merkle_manifest"], ORACLE["op11_merkle_manifest"])
