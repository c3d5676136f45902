"""Every registered query against its SQL check, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import SMALL, entry, oracle_sql, queries
from logstrata.workload.queries import QUERIES as OWN

QUERIES = {name: query for name, query in queries().items() if name in OWN}
CHECKS = {name: sql for name, sql in oracle_sql().items() if name in OWN}


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_check(spark, tables, name):
    mine = QUERIES[name](spark, SMALL)
    columns = sorted(mine.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in mine.collect())
    answer = tables.execute(CHECKS[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted(repr(tuple(r[i] for i in order)) for r in answer.fetchall())
