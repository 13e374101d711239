"""Queries of the training-data operators that SQL can express, against their DuckDB oracles."""

from __future__ import annotations

import json

import duckdb
import pytest

import __spark_entry__ as entry
from granary.llm.queries import ORACLE, QUERIES
from tests.llm.helpers import SMALL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    return con


def test_entry_registers_all_of_them():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    frame = QUERIES[name](spark, SMALL)
    cur = duck.execute(ORACLE[name])
    columns = [c[0] for c in cur.description]
    assert sorted(frame.columns) == sorted(columns)
    found = sorted(json.dumps(list(r), default=str) for r in frame.select(*columns).collect())
    assert found == sorted(json.dumps(list(r), default=str) for r in cur.fetchall())
