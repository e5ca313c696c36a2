"""Ranks, keepers and differences where one key has half the rows."""

from __future__ import annotations

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from curatrix.operators import dedupe, matching, rows


def table(spark):
    rng = random.Random(3)
    data = [("hot" if k % 2 else rng.choice([None, "", *[f"k{x}" for x in range(200)]]), rng.choice(["a", None]) if k % 5 == 0 else "b", rng.randrange(50), k) for k in range(6000)]
    return spark.createDataFrame(data, "k string, j string, v int, id long").repartition(5)


def test_ranks_are_those_of_a_window(spark):
    df = table(spark)
    order = [F.desc("v"), "id"]
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("k", "j").orderBy(*order)))
    got = rows.with_rank(df, ["k", "j"], order, "n")
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert not rows.with_rank(df.limit(0), ["k"], ["id"], "n").collect()


def test_no_range_holds_a_hot_key(spark):
    parts = table(spark).repartitionByRange("k", "id").withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    assert max(r["count"] for r in parts) <= 2 * 6000 / len(parts)


def test_keepers_and_sole_rows(spark):
    df = table(spark)
    w = Window.partitionBy("k").orderBy("v", "id")
    want = df.withColumns({"keep_rank": F.row_number().over(w), "keeper_id": F.first("id").over(w)})
    got = dedupe.with_keeper(df, ["k"], [F.col("v")], "id")
    assert got.select(want.columns).dtypes == want.dtypes
    assert sorted(map(repr, got.select(want.columns).collect())) == sorted(map(repr, want.collect()))
    alone = df.withColumn("n", F.count("*").over(Window.partitionBy("k", "v"))).where("n = 1").drop("n")
    assert sorted(map(repr, matching.unambiguous(df, ["k", "v"]).select(df.columns).collect())) == sorted(map(repr, alone.collect()))
