"""The near-copy stage against brute force over five-word shingles."""

from __future__ import annotations

import random

import numpy as np
import pytest
from nasty import SCHEMA, prose

import corpus_pipeline
from curatrix.llm import near_copies
from curatrix.sources.session import ship_code


def shingle_set(text):
    w = (text or "").lower().split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())


def edited(text, seed, edits):
    w, rng = text.split(), random.Random(seed)
    for k in rng.sample(range(len(w)), edits):
        w[k] = f"changed{seed}x{k}"
    return " ".join(w)


def table():
    rows = [(k, prose(1000 + k, 120)) for k in range(30)]
    rows += [(100 + 10 * k + j, edited(rows[k][1], 31 * k + j, 1 + j)) for k in range(30) for j in range(5)]  # similarity from 0.92 down to 0.65
    rows += [(1000 + k, edited(prose(5, 300), k, 1)) for k in range(40)]  # a bucket of many
    return [(i, t, "en", "s", len(t)) for i, t in rows]


def brute_kept(rows):
    sets = [shingle_set(r[1]) for r in rows]
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    n = 0
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                n += 1
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {rows[k][0] for k in range(len(rows)) if top(k) == k}, n


@pytest.mark.parametrize("small", [16, 2])
def test_stage_keeps_one_of_each_group(spark, small, monkeypatch):
    monkeypatch.setattr(near_copies, "SMALL", small)  # 2: nearly all buckets go by pivots
    rows = sorted(table())
    want, links = brute_kept(rows)
    assert links > 800
    got = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), "").collect()}
    assert got == want


def test_each_row_has_its_own_verdict(spark):
    ship_code(spark)
    a, b = prose(1, 80), prose(2, 80)
    rows = [(1, a, "en", "s", 1), (1, a, "en", "s", 1), (1, b, "en", "s", 1), (None, a, "en", "s", 1), (None, prose(3, 80), "en", "s", 1)]
    got = near_copies.near_copy_filter(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, [rows[0], rows[2], rows[4]]))


def test_recall_of_candidates():
    rng, hit, n = np.random.default_rng(3), 0, 400
    for _ in range(n):  # pairs at similarity 0.8: 160 of 200 shingles in common
        h = np.sort(rng.integers(0, 1 << 63, 200).astype(np.uint64))
        x, y = np.sort(rng.permutation(h)[:180]), None
        gone = rng.permutation(180)[:20]
        y = np.sort(np.concatenate([np.delete(x, gone), np.setdiff1d(h, x)]))
        _, keys = near_copies.sketches(np.concatenate([x, y]), np.array([0, 180, 360]))
        hit += bool((keys[0] == keys[1]).any())
    assert hit >= 0.99 * n


def test_bounds_lose_no_link(spark):
    texts = [edited(prose(5, 120), k, 1 + k % 30) for k in range(60)] + [prose(7, n) for n in (1, 3, 40, 118, 120, 122)] + [""]
    sets = [shingle_set(t) for t in texts]
    names = {s: k for k, s in enumerate(sorted(set().union(*sets)))}
    rows = [(k, [names[x] for x in s], [len(s)]) for k, s in enumerate(sets)]
    held = spark.createDataFrame(rows, "node long, shingles array<long>, cells array<int>")
    hot = spark.createDataFrame([(k % 2 if j else 2, k, len(s)) for k, s in enumerate(sets) for j in (0, 1)], "key long, node long, _size int")
    got = {(r["key"], r["node"]) for r in near_copies.with_partners(hot, held).collect()}
    want = {(key, a) for a in range(len(sets)) for b in range(len(sets)) if a != b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) for key in ({2, a % 2} if a % 2 == b % 2 else {2})}
    assert want and want <= got
    assert len(got) < 2 * len(sets)  # some have left their buckets
