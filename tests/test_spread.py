"""Work is spread over tasks however rows are stored and keys are distributed."""

from __future__ import annotations

from pyspark.sql import functions as F

from curatrix.functions import values as v
from curatrix.operators import catalog, graph, matching


def most_in_a_task(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_covers_of_one_title_are_made_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(matching, "PAIRS_A_PART", 200, raising=False)
    df = spark.range(400).select("id", F.lit("One Title").alias("t"), F.concat(F.lit("A"), F.col("id") % 4).alias("a"))
    found = matching.cover_pairs(df, F.col("t"), F.col("a"), "id", F.col("id") % 10 == 0)
    got = sorted((r["original_id"], r["cover_id"]) for r in found.collect())
    assert got == [(i, j) for i in range(0, 400, 10) for j in range(400) if i % 4 != j % 4]
    assert most_in_a_task(found) < len(got) * 0.6


def test_hits_of_one_key_are_made_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(matching, "PAIRS_A_PART", 200, raising=False)
    queries = spark.createDataFrame([(1, "rock and roll"), (1, "x"), (2, "rockroll"), (3, "none"), (4, None)], "q long, t string")
    index = spark.range(400).select("id", F.when(F.col("id") % 2 == 0, "Rock & Roll").otherwise("rock roll").alias("t"))
    found = matching.all_variant_hits(queries, "q", v.spacing_variants(F.col("t")), index, "id", v.spacing_variants(F.col("t")))
    got = sorted(map(tuple, found.collect()))
    assert got == [(q, i) for q in (1, 2) for i in range(400)]
    assert most_in_a_task(found) < len(got) * 0.6


def test_a_task_makes_no_more_pairs_of_one_key_on_larger_tables(spark, monkeypatch):
    monkeypatch.setattr(matching, "PAIRS_A_PART", 200, raising=False)
    monkeypatch.setattr(matching, "COPIES_A_TASK", 400, raising=False)
    for n in (200, 400):
        df = spark.range(n).select("id", F.lit("One Title").alias("t"), F.concat(F.lit("A"), F.col("id") % 4).alias("a"))
        keys = v.spacing_variants(F.col("t"))
        hits = matching.all_variant_hits(df.select(F.col("id").alias("q"), "t").where("q % 5 = 0"), "q", keys, df, "id", keys)
        assert sorted(map(tuple, hits.collect())) == [(i, j) for i in range(0, n, 5) for j in range(n)]
        covers = matching.cover_pairs(df, F.col("t"), F.col("a"), "id")
        assert sorted((r["original_id"], r["cover_id"]) for r in covers.collect()) == [(i, j) for i in range(n) for j in range(n) if i % 4 != j % 4]
        assert max(most_in_a_task(hits), most_in_a_task(covers)) < 12 * 200


def test_the_graph_of_one_partition_is_written_by_several_tasks(spark):
    rows = spark.range(200).select(F.col("id").alias("n"), F.concat(F.lit("Song "), F.col("id")).alias("Title")).coalesce(1)
    former = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    g = graph.built(rows, "n")
    assert len(g.recordings().inputFiles()) > 1 and g.recordings().count() == 200 and g.links().count() == 600
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == former


def test_readings_of_one_partition_are_made_by_several_tasks(spark):
    rows = spark.range(200).select("id", F.concat(F.lit("A - B"), F.col("id")).alias("t"), F.lit("x").alias("a")).coalesce(1)
    found = catalog.title_candidates(rows, "t", "a")
    assert found.columns == ["id", "t", "a", "position", "cand_title", "cand_artist", "note"]
    assert most_in_a_task(found) < found.count() * 0.6
