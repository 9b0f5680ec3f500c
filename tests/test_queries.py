"""Every registered query against its SQL in another engine, at the smallest scale."""

from __future__ import annotations

import datetime
import math
from decimal import Decimal
from pathlib import Path

import pytest

import __spark_entry__ as driver
from sediment.plans import queries as registered
from sediment.plans.oracle import oracle

duckdb = pytest.importorskip("duckdb")
DATA = Path("/root/testdata/sf0.001")
QUERIES, ORACLE = dict(registered.REGISTRY), oracle()

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def connection():
    con = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, (float, Decimal)):
        return None if math.isnan(value) else round(float(value), 6)
    if isinstance(value, datetime.datetime):
        return value.date()
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(plain(r[i]) for i in order) for r in data),
        key=lambda r: tuple((v is not None, str(v)) for v in r),
    )


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= driver.queries().keys() and ORACLE.keys() <= driver.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    got = QUERIES[name](spark, str(DATA))
    result = connection.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows(got.columns, got.collect()) == rows(columns, result.fetchall())
    plan = got._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ExistingRDD"):
        assert operator not in plan


def test_entry_runs(spark):
    assert driver.entry(spark).count() > 0
