"""Fingerprints and the radius search against brute force."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import simhash
from tests.llm.conftest import ROWS


@pytest.fixture(params=[1_000, 3])
def buckets(request, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", request.param)
    monkeypatch.setattr(simhash, "SHORT", 2 if request.param == 3 else 100_000)


def test_edits(odd, empty, buckets):
    rows = sorted(((i, t or "") for i, t in ROWS), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    following = [t for _, t in rows[1:]] + [rows[0][1]]
    edited = [t[: len(t) - len(t) // 2] + f[: len(t) // 2] for (_, t), f in zip(rows, following, strict=True)]
    wanted = [(i, hashlib.sha256(e.encode()).hexdigest()) for (i, _), e in zip(rows, edited, strict=True)]
    found = simhash.with_edits(odd).collect()
    assert sorted(repr((r["doc_id"], r["edited_sha256"])) for r in found) == sorted(map(repr, wanted))
    found.sort(key=lambda r: wanted.index((r["doc_id"], r["edited_sha256"])))
    assert [r["n_chars"] for r in found] == [len(t) for _, t in rows]
    prints = {}
    for row, (_, text) in zip(found, rows, strict=True):
        assert prints.setdefault(text, row["fingerprint"]) == row["fingerprint"]
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
    for k, row in enumerate(found):
        follower = found[(k + 1) % len(found)]
        bits = (int(row["fingerprint"], 16) ^ int(follower["fingerprint"], 16)).bit_count()
        assert row["near_next"] == pytest.approx(max(0, np.cos(np.pi * bits / 64)))
    assert simhash.with_edits(empty).count() == 0


def test_fingerprint_is_the_sign_of_the_votes(spark):
    df = spark.createDataFrame([(1, "a b c a b c d")], "k long, text string")
    words = "a b c a b c d".split() + [None, None]
    terms = spark.createDataFrame([tuple(words[i : i + 3]) for i in range(7)], "x string, y string, z string")
    hashes = [r[0] for r in terms.select(F.xxhash64(F.struct("x", "y", "z"))).collect()]
    wanted = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprints(df, ["k"], "text").first()["fingerprint"] & (1 << 64) - 1 == wanted


@pytest.mark.parametrize("radius", [0, 3, 6])
def test_radius_search(spark, radius):
    rnd = np.random.default_rng(2)
    base = rnd.integers(-(2**63), 2**63, 40)
    values = [int(b) for b in base]
    for b in base:
        for flips in (1, 3, 4, 7):
            mask = sum(1 << int(k) for k in rnd.choice(63, flips, replace=False))
            values.append(int(b) ^ mask)
    df = spark.createDataFrame([(v,) for v in [*values, values[0], None]], "fingerprint long")
    found = {(r["q"], r["f"]) for r in simhash.within_radius(df, df, radius).collect()}
    wide = {v: v & (1 << 64) - 1 for v in values}
    assert found == {(a, b) for a in wide for b in wide if (wide[a] ^ wide[b]).bit_count() <= radius}


def test_near_documents(odd):
    found = simhash.with_near_documents(simhash.with_edits(odd), every=2).collect()
    for row in found:
        if row["doc_id"] is None or row["doc_id"] % 2:
            assert row["near_docs"] is None
        else:
            near = sum((int(row["fingerprint"], 16) ^ int(other["fingerprint"], 16)).bit_count() <= 3 for other in found)
            assert row["near_docs"] == near - 1
