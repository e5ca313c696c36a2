"""A search by the index finds what a scan finds, and reads less."""

from __future__ import annotations

import pytest

from curatrix.operators import rows, term_index
from curatrix.sources.session import ship_code

COLUMNS = ["title", "artist"]
QUERIES = ["RÜFÜS Underwater", "sol", "du so", "x", "", "ab", "zzz", "under-water, sol", "common", "common rare7", "aaaa", "日本 語", "²x", "the the the", "a1 b2 c3 d4 e5 f6 g7 h8 i9"]


@pytest.fixture(scope="module")
def table(spark):
    ship_code(spark)
    some = [
        (1, "Underwater", "R%C3%9CF%C3%9CS DU SOL"), (2, "Underwater", "Other"), (2, "Solar", None), (None, "no id sol", ""), (None, None, None), (3, "", " "), (4, "aaaa", "aaa"), (5, "aaa aa", "ab"), (6, "日本語", "x²x"),
        (7, "under water-sol", "b"), (8, "word " * 2000 + "needle", "du"), (9, "x" * 3000 + "ab", "so"), (10, "a1 b2 c3 d4", "e5 f6 g7 h8"),
    ]
    return spark.createDataFrame([*some, *[(100 + i, f"common {'rare7' if i == 77 else i}", "sol" if i % 50 == 0 else "y") for i in range(400)]], "id int, title string, artist string").repartition(3)


@pytest.fixture(scope="module")
def index(table, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('index')}/i"
    term_index.build(table, path, "id", COLUMNS, parts=16)
    return path


def plain(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.mark.parametrize("query", QUERIES)
def test_index_finds_what_a_scan_finds(spark, table, index, query):
    got = term_index.search(spark, index, query, "id", COLUMNS)
    assert got.columns == table.columns and plain(got) == plain(rows.vibe_search(table, query, COLUMNS))


def test_a_search_reads_few_postings_and_parts(spark, table, index):
    wanted = term_index.looked_up(spark, index, ["common", "rare7"])
    assert wanted == ["are", "com", "mmo", "rar"]  # two of each term, the rarest, by letters where equal
    plan = term_index.search(spark, index, "common rare7", "id", COLUMNS)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_part" in plan.partition("PartitionFilters")[2].partition("]")[0]
    hit = term_index.search(spark, index, "rare7", "id", COLUMNS).collect()
    assert [r["id"] for r in hit] == [177]
    read = spark.read.parquet(f"{index}/postings").where("gram = 're7'")
    assert "PushedFilters: [IsNotNull(gram), EqualTo(gram,re7)]" in read._jdf.queryExecution().executedPlan().toString()


def test_an_empty_table(spark, table, tmp_path):
    term_index.build(table.limit(0), f"{tmp_path}/i", "id", COLUMNS)
    assert term_index.looked_up(spark, f"{tmp_path}/i", ["sol"]) is None
    assert [term_index.search(spark, f"{tmp_path}/i", q, "id", COLUMNS).count() for q in ("sol", "")] == [0, 0]
