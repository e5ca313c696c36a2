"""Catalogs with ids above a million, which are also the ids of rows that a query adds."""

from __future__ import annotations

import duckdb
import pytest

from curatrix.plans import catalogue


@pytest.mark.parametrize("name", ["decided_catalog", "upsert_catalog"])
def test_added_rows_stay_apart_from_rows_of_the_same_id(spark, tmp_path, name):
    ids = [*range(40), 85, 1_000_000, 1_000_017, 1_000_034, 1_000_085, 1_000_086]
    parts = [(i, f"name {i}", f"Brand#{i % 3}", f"type {i % 4}", i % 50, 900.0) for i in ids]
    path = str(tmp_path / "part.parquet")
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").coalesce(1).write.parquet(path)
    got = catalogue.QUERIES[name](spark, str(tmp_path))
    want = duckdb.connect().execute(f"WITH part AS (SELECT * FROM '{path}/*.parquet') {catalogue.ORACLES[name].replace('WITH ', ', ', 1)}").fetchall()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
