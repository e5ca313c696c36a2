"""Differences from trees of digests against whole comparisons, and how much of the tables they read."""

from __future__ import annotations

import random

import pytest

from curatrix.operators import difftree, rows, versions
from curatrix.operators.difftree import Difference, Tree

SCHEMA = "k string, v string, n int"


def frames(spark, left, right):
    return [spark.createDataFrame(x, SCHEMA).repartition(3) for x in (left, right)]


def same(a, b):
    return sorted(map(repr, map(tuple, a.collect()))) == sorted(map(repr, map(tuple, b.collect())))


@pytest.mark.parametrize("case", ["equal", "one side", "hot"])
def test_same_results_as_whole_tables(spark, tmp_path, case):
    rng = random.Random(case)
    left = [(f"k{rng.randrange(700)}" if case != "hot" or k % 2 else "hot", f"v{k % 7}", k % 5) for k in range(1500)]
    right = [r for r in left if rng.random() > 0.02] + [(f"new{k}", None, k) for k in range(20)] + [left[5]]
    right = [(k, "changed" if rng.random() < 0.02 else v, n) for k, v, n in right] + [(None, "x", 1), ("", "y", None)]
    left = {"empty": [], "one side": []}.get(case, left)
    right = {"equal": left, "empty": []}.get(case, right)
    a, b = frames(spark, left, right)
    found = Difference(Tree.write(a, ["k"], f"{tmp_path}/a", 8), Tree.write(b, ["k"], f"{tmp_path}/b", 8))
    x, y = found.rows()
    assert same(rows.multiset_difference(x, y, ["k"], ["v", "n"]).groupBy("k").count(), rows.multiset_difference(a, b, ["k"], ["v", "n"]).groupBy("k").count())
    assert same(versions.field_differences(x, y, ["k"], ["v", "n"], {}), versions.field_differences(a, b, ["k"], ["v", "n"], {}))
    whole = versions.key_census(a.where("k is not null"), b.where("k is not null"), ["k"])
    census = found.census().first()
    nulls = [int(any(r[0] is None for r in t)) for t in (left, right)]
    want = whole.first()
    assert (census["left_keys"], census["right_keys"]) == (want["left_keys"] + nulls[0], want["right_keys"] + nulls[1])
    if case == "equal":
        assert found.compared == [1] and found.hashes_read == 0 and not x.count()


def test_work_follows_the_difference(spark, tmp_path):
    base = [(f"k{k}", f"v{k}", k) for k in range(8_000)]
    few = [(k, "new" if n % 1000 == 0 else v, n) for k, v, n in base]  # a thousandth
    many = [(k, "new" if n % 100 == 0 else v, n) for k, v, n in base]  # a hundredth
    trees = [Tree.write(spark.createDataFrame(x, SCHEMA), ["k"], f"{tmp_path}/{i}", 16) for i, x in enumerate((base, few, many))]
    one, two = Difference(trees[0], trees[1]), Difference(trees[0], trees[2])
    assert one.changed.count() == 8 and two.changed.count() == 80
    assert one.hashes_read < 0.02 * 16_000 and two.hashes_read < 0.12 * 16_000  # key and row hashes only
    assert [x.count() for x in two.rows()] == [80, 80]
    assert one.compared[0] == 1 and sum(one.compared) < sum(two.compared)


def test_leaves_by_join_or_by_ranges(spark, tmp_path, monkeypatch):
    a, b = frames(spark, [(f"k{k}", "v", k) for k in range(200)], [(f"k{k}", "v", k + k % 2) for k in range(200)])
    trees = [Tree.write(x, ["k"], f"{tmp_path}/{i}", 4) for i, x in enumerate((a, b))]
    counts = []
    for pushed in (1, 64):
        monkeypatch.setattr(difftree, "PUSHED", pushed)
        counts.append([x.count() for x in Difference(*trees).rows()])
    assert counts == [[100, 100]] * 2


def test_other_columns_are_an_error(spark, tmp_path):
    a, b = frames(spark, [("k", "v", 1)], [("k", "v", 1)])
    with pytest.raises(ValueError):
        Difference(Tree.write(a, ["k"], f"{tmp_path}/a"), Tree.write(b.drop("n"), ["k"], f"{tmp_path}/b"))
