"""Small tables with every odd case: nulls, empty and long texts, ties, repeated rows, clashing column names."""

from pathlib import Path

import duckdb
import public_tokenizers
import pytest

from gaugeworks.llm.queries import ship

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

LONG = " ".join(f"word{i % 97}" for i in range(4000))
ROWS = [
    (0, "The quick brown fox jumps over the lazy dog, and then it rests."),
    (1, "The quick brown fox jumps over the lazy dog, and then it rests."),
    (2, "THE QUICK brown fox\tjumps over the lazy dog,\nand then it rests."),
    (3, "The quick brown fox jumps over the lazy dog, and then it rests again."),
    (4, ""),
    (5, None),
    (6, " \t\n "),
    (7, "short"),
    (7, "short"),
    (8, LONG),
    (9, LONG + " tail"),
    (10, "x" * 3000),
    (11, "naïve café 日本語 😀 <|endoftext|> It's 2024!!!\x1c"),
    (None, "The quick brown fox jumps over the lazy dog, and then it rests."),
    (-5, "ein ganz anderer Text in deutscher Sprache, der nichts mit den anderen zu tun hat"),
]
SCHEMA = "doc_id long, text string, id string, node long, key string, n long"


@pytest.fixture(scope="session")
def odd(spark):
    ship(spark)
    return spark.createDataFrame([(i, t, "clash", 1, "k", 2) for i, t in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    ship(spark)
    return spark.createDataFrame([], SCHEMA)


def same_as_sql(spark, query, sql, folder="/root/testdata/sf0.001"):
    """The query's rows over the test tables are those of its SQL."""
    if not Path(folder).exists():
        pytest.skip("test tables not present")
    duck = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    want = duck.execute(sql)
    names = sorted(c[0] for c in want.description)
    found = query(spark, folder)
    assert sorted(found.columns) == names
    rows = lambda columns, got: sorted(repr([dict(zip(columns, r, strict=True))[n] for n in names]) for r in got)
    assert rows(found.columns, map(tuple, found.collect())) == rows([c[0] for c in want.description], want.fetchall())
