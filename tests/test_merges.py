"""The whole catalog after a merge with a legacy one."""

from __future__ import annotations

from curatrix.operators import versions


def test_merged_catalog(spark):
    base = [("a", "", "i1", ""), ("b", "y", "", "s"), ("c", "", "", ""), ("c", "z", "", ""), ("d", None, None, None), (None, "", "", ""), ("e", "full", "i", "")]
    legacy = [("a", "new", "o1"), ("b", "other", "o2"), ("c", "w", ""), ("d", "p", ""), ("d", "q", ""), ("n", "r", "o3"), ("n", "s", None), (None, "null key", "o4"), ("e", "", " ")]
    b = spark.createDataFrame(base, "k string, album string, track string, sources string").repartition(3)
    old = spark.createDataFrame(legacy, "k string, album string, old_id string").repartition(2)
    got = versions.merged_catalog(b, old, ["k"], ["album"], {"track": "old_id"}, {"sources": "legacy"})
    assert got.columns == ["k", "album", "track", "sources", "outcome", "n_filled"]
    want = [
        ("a", "new", "i1", "legacy", "filled", 1), ("b", "y", "o2", "s; legacy", "filled", 1), ("c", "", "", "", "ambiguous", 0), ("c", "z", "", "", "ambiguous", 0), ("d", None, None, None, "ambiguous", 0),
        (None, "null key", "o4", "legacy", "filled", 2), ("e", "full", "i", "", "kept", 0), ("n", "r", "o3", "legacy", "appended", 0), ("n", "s", None, "legacy", "appended", 0),
    ]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert sorted(r["outcome"] for r in versions.merged_catalog(b.limit(0), old, ["k"], ["album"]).collect()) == ["appended"] * 9
    assert {r["outcome"] for r in versions.merged_catalog(b, old.limit(0), ["k"], ["album"]).collect()} == {"kept"}
