"""Every registered query against its DuckDB oracle on the smallest driver tables."""

from __future__ import annotations

import datetime as dt
import json
import os

import duckdb
import pytest

import __spark_entry__ as entry
from granary.plans import catalog
from tests.conftest import SMALL_SF

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL_SF), reason="driver tables not present")


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(json.dumps([_norm(r[i]) for i in order], default=str) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("orders", "lineitem"):
        con.execute(f"create view {t} as select * from '{SMALL_SF}/{t}.parquet'")
    return con


def test_every_query_has_an_oracle():
    """The queries of the training-data operators have their own tests, most of them no SQL."""
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(catalog.ORACLE) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["platform", "outcome", "year", "granule_count"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = catalog.QUERIES[name](spark, SMALL_SF)
    s_rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(catalog.ORACLE[name])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert _canon(df.columns, s_rows) == _canon(d_cols, d_rows)
