"""The registered queries run on the smallest tables and agree with their SQL."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from curatrix.plans import catalogue

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(DATA):
        pytest.skip("no test tables here")
    connection = duckdb.connect()
    connection.execute("SET timezone = 'UTC'")
    for path in glob.glob(f"{DATA}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    return None if value is None else f"{value:.9g}" if isinstance(value, (int, float)) and not isinstance(value, bool) else str(value)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_matches_its_sql(spark, duck, name):
    got = catalogue.QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    rows = sorted([[plain(r[c]) for c in columns] for r in got.collect()], key=repr)
    if name not in catalogue.ORACLES:
        assert rows
        return
    found = duck.execute(catalogue.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = sorted([[plain(r[names.index(c)]) for c in columns] for r in found.fetchall()], key=repr)
    assert rows == want


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
