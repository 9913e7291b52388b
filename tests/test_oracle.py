"""Every query with SQL gives the rows that DuckDB gives for it."""

import math

import duckdb
import pytest

import __spark_entry__
from inkstone.plans.queries import ORACLES, TABLES

SF = "/root/testdata/sf0.001"


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    return round(float(v), 5) if isinstance(v, (int, float)) else str(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    got = __spark_entry__.queries()[name](spark, SF)
    columns = sorted(got.columns)
    expected = duck.sql(__spark_entry__.oracle_sql()[name])
    assert sorted(expected.columns) == columns
    key = lambda r: [str(v) for v in r]
    rows = sorted(([plain(v) for v in r] for r in got.select(*columns).collect()), key=key)
    assert rows == sorted(([plain(v) for v in r] for r in expected.select(*(f'"{c}"' for c in columns)).fetchall()), key=key)


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0
