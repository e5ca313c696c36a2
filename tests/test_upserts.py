"""Upserts in order against the loop that they stand for."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from curatrix.operators import upserts
from curatrix.plans import catalogue
from curatrix.sources.session import ship_code

DATA = "/root/testdata/sf0.001"


def sequential(base, inputs):
    """base: (id, keys, last, first); inputs: (n, keys, new keys, last, first)."""
    rows = [[i, "base", 0, a or None, b or None, set(k)] for i, k, a, b in base]
    index = {}
    for r in rows:
        for k in r[5]:
            index.setdefault(k, []).append(r)
    for n, keys, new, a, b in sorted(inputs):
        hits = [(k, r) for k in dict.fromkeys(keys) for r in index.get(k, [])]
        if hits:
            for _, r in hits:
                r[2] += 1
            for r in {id(r): r for _, r in hits}.values():
                r[3], r[4] = a or r[3], r[4] or b or None
        else:
            r = [-n - 1, "appended", 0, a or None, b or None, set(new) & set(keys)]
            rows.append(r)
            for k in r[5]:
                index.setdefault(k, []).append(r)
    return sorted(tuple(r[:5]) for r in rows)


def run(spark, base, inputs, **options):
    b = spark.createDataFrame(base, "id long, keys array<string>, a string, b string")
    i = spark.createDataFrame(inputs, "n long, keys array<string>, new array<string>, a string, b string").repartition(3)
    got = upserts.transitive_upsert(b, i, "id", "n", F.col("keys"), F.col("keys"), ["a"], ["b"], F.col("new"), **options)
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("seed", range(3))
def test_random_batches(spark, seed, monkeypatch):
    ship_code(spark)
    rng = random.Random(seed)
    monkeypatch.setattr(upserts.appended_inputs, "__defaults__", ([1, 2, 6][seed], 40))  # components after so many rounds, and not all small
    key = lambda: rng.choice(["hot"] * 6 + [f"k{rng.randrange(120)}" for _ in range(12)])
    base = [(i, [key() for _ in range(2)] if i % 2 else [f"b{i}"], rng.choice(["", "x"]), rng.choice(["", "y"])) for i in range(20)]
    base = [r for r in base if "hot" not in r[1]] if seed else base
    inputs = []
    for n in range(300):
        keys = [key() for _ in range(rng.randrange(4))] + ([f"b{rng.randrange(20)}"] if rng.random() < 0.1 else [])
        inputs.append((n, keys, keys if seed != 1 else keys[:1], rng.choice(["", f"a{n}"]), rng.choice(["", f"f{n}"])))
    assert run(spark, base, inputs) == sequential(base, inputs)


def test_a_long_chain_is_folded(spark):
    ship_code(spark)
    inputs = [(n, [f"k{n}", f"k{n + 1}"], [f"k{n}", f"k{n + 1}"], f"a{n}", "") for n in range(60)]
    assert run(spark, [], inputs) == sequential([], inputs)


def test_awkward_rows(spark):
    ship_code(spark)
    assert run(spark, [], []) == []
    base = [(1, None, None, " "), (2, ["", "k"], "x", None), (3, ["k", "k"], "", "z")]
    inputs = [(0, ["k", "k", "", None], ["k"], " ", "f"), (1, [], [], "a", ""), (2, [""], [], "b", ""), (3, None, None, "c", "")]
    want = sequential([(1, [], "", ""), (2, ["k"], "x", ""), (3, ["k"], "", "z")], [(0, ["k"], ["k"], "", "f"), (1, [], [], "a", ""), (2, [], [], "b", ""), (3, [], [], "c", "")])
    assert run(spark, base, inputs) == want


def test_components_of_a_path(spark):
    ship_code(spark)
    members = spark.createDataFrame([(n, k) for n in range(200) for k in (n, n + 1)] + [(500, 900), (501, 900)], "item long, key long")
    got = dict(upserts.connected(members, "item", "key").collect())
    assert got == {**{n: 0 for n in range(200)}, 500: 500, 501: 500}


def test_registered_query(spark):
    if not os.path.isdir(DATA):
        pytest.skip("no test tables here")
    got = sorted((r["id"], r["origin"], r["n_inputs"], r["priority"], r["status"]) for r in catalogue.QUERIES["transitive_upsert"](spark, DATA).collect())
    base = [(r["c_custkey"], [f"c{r['c_custkey']}"], "", r["c_mktsegment"]) for r in spark.read.parquet(f"{DATA}/customer.parquet").where("c_custkey % 3 = 0").collect()]
    inputs = []
    for r in spark.read.parquet(f"{DATA}/orders.parquet").collect():
        keys = [f"c{r['o_custkey']}"] + ([f"d{str(r['o_orderdate'])[:10]}"] if r["o_orderkey"] % 2 == 0 else [])
        inputs.append((r["o_orderkey"], keys, keys, r["o_orderpriority"], r["o_orderstatus"]))
    assert got == sequential(base, inputs)
