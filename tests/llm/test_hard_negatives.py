"""Hard negatives against all pairs in plain Python."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from curatrix.llm import hard_negatives
from curatrix.llm.hard_negatives import Block
from curatrix.sources.session import ship_code

SCHEMA = "vec_id long, embedding array<float>, label int"
NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows):
    rows = [(i, tuple(math.floor(256 * float(np.float32(x))) for x in v), k) for i, v, k in rows if i is not None and k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: max(min(sum(x * y for x, y in zip(a, b, strict=False)), 2**63 - 1), 1 - 2**63)
    out = []
    for i, v, k in {r for r in rows if r[0] % 100 == 0}:
        scored = sorted((-dot(v, w), j, m) for j, w, m in rows)
        for s, j, _ in [x for x in scored if x[2] == k and x[1] != i][:5]:
            found = [x for x in scored if x[2] != k and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(i, j, r, x[1], -s, -x[0]) for r, x in enumerate(found, 1)]
    return sorted(out)


def vectors():
    rng = random.Random(3)
    vec = lambda n=12: [rng.gauss(0, 0.4) for _ in range(n)]
    rows = [(i, vec(), rng.randrange(3)) for i in range(900)]
    common = vec()
    rows += [(i, common, 1 + i % 2) for i in range(1000, 1400)]  # one vector a hot group, many ties
    rows += [(2000, [0.0] * 12, 1), (2001, vec(3), 1), (2100, vec(20), 2), (2200, [], 0), (2201, [], 1)]
    rows += [rows[100], rows[100], rows[7], (300, vec(), 2)]  # repeated rows, an anchor with two vectors
    rows += [(None, vec(), 1), (2300, None, 1), (2400, vec(), None), (2500, [1.0, None], 1), (2600, [float("nan")], 1), (2700, [float("inf"), 1.0], 1)]
    return rows


@pytest.mark.parametrize("step", [1, 8])
def test_all_pairs_agree(spark, monkeypatch, step):
    ship_code(spark)
    monkeypatch.setattr(hard_negatives, "STEP", step)
    rows = vectors()
    table = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({"anchor": F.lit("x"), "block": F.lit(1), "positives": F.lit(2)})
    got = sorted(tuple(r[c] for c in NAMES) for r in hard_negatives.hard_negatives(table).collect())
    assert got == brute(rows)


def test_more_blocks_than_partitions(spark, monkeypatch):
    ship_code(spark)
    rows = vectors()
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 50)
    got = sorted(tuple(r[c] for c in NAMES) for r in hard_negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == brute(rows)


def test_huge_components_stay_exact(spark):
    ship_code(spark)
    rows = [(0, [3e4, 1.0], 0), (1, [3e4, 2.0], 0), (2, [3e4, 1.5], 1), (100, [2e9, 1.0], 0), (3, [1e9, 7.0], 0), (4, [9e8, 3.0], 1), (200, [3e38], 2), (5, [3e38], 2), (6, [2.9e38], 1)]
    got = sorted(tuple(r[c] for c in NAMES) for r in hard_negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == brute(rows)


def test_no_rows(spark):
    ship_code(spark)
    got = hard_negatives.hard_negatives(spark.createDataFrame([], SCHEMA))
    assert got.columns == NAMES and not got.collect()
    assert not hard_negatives.hard_negatives(spark.createDataFrame([(1, [1.0], 1), (2, [1.0], 2)], SCHEMA)).collect()  # no anchor


def test_the_bitmap_shrinks_and_loses_no_row():
    rng = np.random.default_rng(0)
    base = rng.normal(0, 1, 32) * np.geomspace(300, 2, 32)
    vectors = np.floor(rng.normal(0, 1, (4000, 32)) * np.geomspace(300, 2, 32))
    vectors[7] = np.floor(base)
    block, seen = Block(np.arange(4000), np.zeros(4000, np.int64), vectors), []

    def still(low, high):
        seen.append(len(low))
        return high >= hard_negatives.kth(low)

    rows, score = block.scan(np.floor(base), np.arange(4000), still)
    exact = vectors @ np.floor(base)
    want = np.argsort(-exact, kind="stable")[:5]
    assert set(want) <= set(block.vec_id[rows]) and seen[-1] < 400
    assert (score == exact[block.vec_id[rows]]).all()
