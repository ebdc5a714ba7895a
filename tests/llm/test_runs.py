"""Periodic runs against a search of every period by itself."""

import hashlib
import random
import re
import zlib
from fractions import Fraction
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import runs
from gaugeworks.llm.queries import QUERIES
from tests.llm.conftest import LONG, ROWS


def _brute(words):
    n, found = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(24, 3 * q):
                part = words[start : start + length]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    found.append((start, length, q))
            i += i == start
    return sorted(found)


def _random_words(rnd):
    words = []
    for _ in range(rnd.randint(0, 8)):
        kind = rnd.randint(0, 3)
        if kind == 0:
            words += [rnd.choice("ab")] * rnd.randint(1, 40)
        elif kind == 1:
            unit = [rnd.choice("abc") for _ in range(rnd.randint(1, 14))]
            words += unit * rnd.randint(1, 6) + unit[: rnd.randint(0, len(unit))]
        elif kind == 2 and words:
            at = rnd.randrange(len(words))
            words += words[at : at + rnd.randint(1, 50)]
        else:
            words += [rnd.choice("abcdefghij") for _ in range(rnd.randint(1, 15))]
    return words


TEXTS = [_random_words(random.Random(k)) for k in range(700)]
#: Fibonacci words are full of squares and cubes; Thue-Morse words have no cube.
THUE = "a"
while len(THUE) < 700:
    THUE += THUE.translate({97: 98, 98: 97})
FIB = ["a", "ab"]
while len(FIB[-1]) < 700:
    FIB.append(FIB[-1] + FIB[-2])


def test_runs_in_random_words():
    wanted = [_brute(w) for w in TEXTS]
    assert sum(map(len, wanted)) > 500 and any(len(w) > 1 for w in wanted)
    assert [runs.runs_in(w) for w in TEXTS] == wanted
    as_bytes = [[x.encode() for x in w] for w in TEXTS]
    assert runs.text_runs(as_bytes) == wanted
    assert [runs.text_runs([w])[0] for w in as_bytes] == wanted


@pytest.mark.parametrize("word", [FIB[-1], THUE, "a" * 1000, ("ab" * 30 + "c") * 9, "a" * 23, "a" * 24, "abcdefgh" * 3, "abcdefghi" * 3, "abcdefghi" * 3 + "abc", "abcdefg" * 3 + "ab"])
def test_runs_in_words_of_known_shape(word):
    assert runs.runs_in(word) == _brute(word)
    assert runs.text_runs([[], [c.encode() for c in word], [c.encode() for c in word[1:]]])[1:] == [_brute(word), _brute(word[1:])]


def test_equal_hashes_only_make_stretches_longer(monkeypatch):
    monkeypatch.setattr(runs, "hash", lambda word: 7, raising=False)
    as_bytes = [[x.encode() for x in w] for w in TEXTS[:150]]
    assert runs.text_runs(as_bytes) == [_brute(w) for w in TEXTS[:150]]


def _collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_collapse_of_odd_rows(spark, odd, empty):
    more = [(20, "  a\x85b\x1cc\v" * 30 + " end"), (21, "so\tit\ngoes " * 40), (None, "x " * 24), (None, "x " * 24), (22, LONG * 3)]
    extra = spark.createDataFrame([(i, t, "clash", [1]) for i, t in more], "doc_id long, text string, collapsed string, runs array<int>")
    rows = runs.collapse(odd.select("doc_id", "text").unionByName(extra.select("doc_id", "text"))).collect() + runs.collapse(extra).collect()
    wanted = []
    for i, t in [*ROWS, *more, *more]:
        words = _words(t)
        found = _brute(words) if len(words) < 2000 else runs.runs_in(words)
        wanted.append(repr((i, len(words), found, _collapsed(words, found))))
    assert sorted(repr((r[0], r[1], [tuple(x) for x in r[2]], r[3])) for r in rows) == sorted(wanted)
    assert runs.collapse(empty).count() == 0


def test_strongest_run(spark):
    cases = [[], [(0, 24, 8)], [(0, 30, 10), (5, 60, 20), (9, 24, 8)], [(0, 25, 8), (40, 49, 16), (100, 28, 9)], [(3, 100, 7), (3, 101, 7)]]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, runs array<struct<start:long,length:long,period:long>>")
    found = {r["i"]: r["b"] and tuple(r["b"]) for r in df.select("i", runs.strongest(F.col("runs")).alias("b")).collect()}
    for i, case in enumerate(cases):
        assert found[i] == (min(case, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if case else None)


def test_query_over_whole_documents(spark):
    folder = "/root/testdata/sf0.001"
    if not Path(folder).exists():
        pytest.skip("test tables not present")
    wanted = []
    for i, text in duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall():
        words = _words(text)
        n, h = len(words), zlib.crc32(str(i).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[a + (k - a) % p] if k >= a else w for k, w in enumerate(words)]
        found = _brute(words) if n < 1500 else runs.runs_in(words)
        s, length, q = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
        told = "".join(f"{a},{b},{c}\n" for a, b, c in found)
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (told, _collapsed(words, found))]
        wanted.append((i, len(found), s, length, q, found and 1000 * length // q or None, *digest))
    got = QUERIES["op13_periodic_runs"](spark, folder)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(wanted)
    assert sum(r[1] > 0 for r in wanted) > 5
