"""Every registered query against its SQL on the smallest tables, and the driver's contract."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from recordscope.plans.catalogue import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    yield con
    con.close()


def plain(v):
    """A value in a form in which both engines' results are equal."""
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5)
    if isinstance(v, datetime.datetime) and v.time() == datetime.time():
        return v.date()
    if isinstance(v, list | tuple):
        return tuple(plain(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=str)


def alike(a, b):
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(map(alike, a, b))
    if isinstance(a, float | int) and isinstance(b, float | int) and not isinstance(a, bool):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=2e-5)
    return a == b


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = rows_of(df.columns, df.collect())
    if name not in ORACLES:
        assert got
        return
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    want = rows_of(columns, result.fetchall())
    assert len(got) == len(want) and all(map(alike, got, want))


def test_entry_and_registry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(QUERIES) <= set(entry.queries())
