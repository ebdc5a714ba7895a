"""Every registered query against its SQL on the test tables."""

import datetime
import math
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from gaugeworks.plans.oracle import ORACLE
from gaugeworks.plans.workload import QUERIES

FOLDER = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, datetime.date | datetime.datetime):
        return value.isoformat()
    return repr(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def test_same_names():
    assert set(ORACLE) == set(QUERIES)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    result = queries()[name](spark, FOLDER)
    expected = duck.execute(oracle_sql()[name])
    names = [column[0] for column in expected.description]
    want, got = _rows(names, expected.fetchall()), _rows(result.columns, result.collect())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
    assert got[1], "the query must return rows"


def test_entry(spark):
    result = entry(spark)
    assert result.columns == ["geo_place_name", "mean_value"] and result.count() == 10
