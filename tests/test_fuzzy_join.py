"""Joins by similarity against all pairs, and the operators over scored pairs as wholes, by difflib in plain Python."""

from __future__ import annotations

import itertools
import os
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from curatrix.functions.fuzzy import match_score
from curatrix.operators import fuzzy_join, matching
from curatrix.plans import catalogue, match
from curatrix.sources.session import ship_code

DATA = "/root/testdata/sf0.001"


def words(seed, n):
    rng = random.Random(seed)
    stems = ["river", "stone", "night", "the", "love", "été", "x", "a", "ab", "blue train", "😀 song", "aaaa", "tonight"]
    out = []
    for _ in range(n):
        t = " ".join(rng.choice(stems) for _ in range(rng.randrange(1, 4)))
        for _ in range(rng.randrange(3)):
            k = rng.randrange(len(t) + 1)
            t = t[:k] + rng.choice(["", "z", "e"]) + t[k + rng.randrange(2) :]
        out.append(t)
    return [*out, "", "a", "b", "ab", "ba", "abc", "aa", "aaa", "q" * 300, "q" * 290 + "w" * 10]


@pytest.mark.parametrize("least", [0.5, 0.85])
def test_no_pair_is_lost(spark, least):
    ship_code(spark)
    a, b = sorted(set(words(1, 120))), sorted(set(words(2, 120)))
    frame = lambda v: spark.createDataFrame([(t,) for t in v], "text string").repartition(3)
    got = {(r["a"], r["b"]) for r in fuzzy_join.similar_texts(frame(a), frame(b), least).collect()}
    assert got == {(x, y) for x, y in itertools.product(a, b) if x and y and SequenceMatcher(None, x, y).ratio() >= least}
    pairs = fuzzy_join.candidate_texts(frame(a), frame(b), least)
    assert pairs.count() == pairs.distinct().count()
    inside = {(r["a"], r["b"]) for r in fuzzy_join.containing_texts(frame(a), frame(b)).collect()}
    assert inside == {(x, y) for x, y in itertools.product(a, b) if x and y and (x in y or y in x)}


def test_few_candidates_and_copies_cost_nothing(spark):
    ship_code(spark)
    rng = random.Random(6)
    names = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20)) for _ in range(500)]
    rows = [(t,) for t in names] + [(names[0],)] * 3000
    close = [(t[:9] + "#" + t[10:],) for t in names[:50]]
    found = fuzzy_join.candidate_texts(spark.createDataFrame(rows, "text string"), spark.createDataFrame(close, "text string"), 0.9)
    assert 50 <= found.count() <= 100  # of 25,000 pairs of distinct texts
    with pytest.raises(ValueError):
        fuzzy_join.candidate_texts(found.select(F.col("a").alias("text")), found.select(F.col("a").alias("text")), 0)


def scored_pairs(spark, left, right):
    """Every pair with its score, by the library's own pair score (tested against difflib in test_functions)."""
    both = left.crossJoin(right)
    return both.withColumn("s", match_score(F.col("title"), F.col("artist"), F.col("r_title"), F.col("r_artist")))


@pytest.mark.parametrize("least", [0.85, 0.99])
def test_best_of_all_pairs(spark, least):
    ship_code(spark)
    rng = random.Random(9)
    artists = ["The Beatles", "Beatles", "ABBA", "Queen", "", None, "Simon & Garfunkel"]
    left = spark.createDataFrame([(i, t or None, rng.choice(artists)) for i, t in enumerate(words(3, 60) * 2)], "query_id long, title string, artist string")
    right = spark.createDataFrame([(i, t or None, rng.choice(artists)) for i, t in enumerate(words(4, 90))], "id long, title string, artist string")
    got = {(r["query_id"], r["id"], round(r["match_score"], 9)) for r in fuzzy_join.fuzzy_join(left, "query_id", ("title", "artist"), right, "id", ("title", "artist"), least).collect()}
    best = {}
    for r in scored_pairs(spark, left, right.toDF("id", "r_title", "r_artist")).where(F.col("s") >= least).collect():
        best[r["query_id"]] = min(best.get(r["query_id"], (0, 0)), (-r["s"], r["id"]))
    assert got == {(q, i, round(-s, 9)) for q, (s, i) in best.items()} and got


def test_registered_join(spark):
    if not os.path.isdir(DATA):
        pytest.skip("no test tables here")
    got = {(r["query_id"], r["id"], r["match_score"]) for r in catalogue.QUERIES["fuzzy_join"](spark, DATA).collect()}
    right = match.catalog(spark, DATA).select("id", F.col("title").alias("r_title"), F.col("artist").alias("r_artist"))
    best = {}
    for r in scored_pairs(spark, match.misspelt(spark, DATA), right).where("s >= 0.9").collect():
        best[r["query_id"]] = min(best.get(r["query_id"], (0, 0)), (-r["s"], r["id"]))
    assert got == {(q, i, round(-s, 6)) for q, (s, i) in best.items()} and got


def plain_score(t1, a1, t2, a2):
    ratio = lambda x, y: SequenceMatcher(None, x, y).ratio() if x and y else 0.0
    t = 0.0 if not t1 or not t2 else 1.0 if t1 == t2 else 0.99 if t1 in t2 or t2 in t1 else ratio(t1, t2)
    a = 0.5 if not a1 else 0.0 if not a2 else 1.0 if a1 == a2 else max(ratio(a1, a2), 0.95) if a1 in a2 or a2 in a1 else ratio(a1, a2)
    return min(1.0, 0.72 * t + 0.28 * a + 0.04 * (t > 0.97) + 0.03 * (a > 0.9) + 0.05 * (a1 != "" and a1 == a2))


def test_best_and_waterfall_as_wholes(spark):
    """fuzzy_best and provider_waterfall on plain lower-case words, for which title and artist keys are the words themselves."""
    ship_code(spark)
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randrange(3, 8)))
    rows = [(q, word() if q % 4 else "", word(), c, p, word(), word()) for q in range(40) for c in range(4) for p in range(2)]
    rows = [(q, f"q{q}", "band" if q % 3 else "", c, p, f"q{q}" if rng.random() < 0.2 else t, "band" if rng.random() < 0.3 else a) for q, _, _, c, p, t, a in rows]
    df = spark.createDataFrame(rows, "q long, t string, a string, candidate_pos long, provider_rank long, t2 string, a2 string").repartition(3)
    got = {(r["q"], r["candidate_pos"], r["provider_rank"], round(r["match_score"], 9)) for r in matching.fuzzy_best(df, "q", ("t", "a"), ("t2", "a2"), ["candidate_pos", "provider_rank"]).collect()}
    scores = {(q, c, p): plain_score(t, a, t2, a2) for q, t, a, c, p, t2, a2 in rows}
    want = set()
    for q in range(40):
        s, c, p = min((-s, c, p) for (k, c, p), s in scores.items() if k == q)
        want.add((q, c, p, round(-s, 9)))
    assert got == want
    scored = df.withColumn("match_score", match_score(F.col("t"), F.col("a"), F.col("t2"), F.col("a2")))
    chosen = {(r["q"], r["candidate_pos"], r["provider_rank"]) for r in matching.provider_waterfall(scored, "q", enough=0.97, least=0.6).collect()}
    want = set()
    for q in range(40):
        mine = sorted((c, p, s) for (k, c, p), s in scores.items() if k == q and s >= 0.6)
        enough = [x for x in mine if x[2] >= 0.97]
        if mine:
            want.add((q, *(enough[0] if enough else min(mine, key=lambda x: (-x[2], x[0], x[1])))[:2]))
    assert chosen == want
