"""Scores of title cores and artist keys that were made before rows were paired."""

from __future__ import annotations

from pyspark.sql import functions as F

from curatrix.functions import text
from curatrix.operators import matching


def test_best_of_prepared_columns_is_the_same(spark):
    pairs = [(1, "The Song (Live)", "A & B feat. C", f, g, n) for n, (f, g) in enumerate([("Song", "A and B"), ("the song - live", "b"), ("", ""), ("Sung", "A")])] + [(2, "", "x", "y", "", 9)]
    df = spark.createDataFrame(pairs, "q int, t string, a string, t2 string, a2 string, n int")
    df = df.withColumns({f"{c}_p": (text.title_core if c[0] == "t" else text.fuzzy_key)(F.col(c)) for c in ("t", "a", "t2", "a2")})
    plain = matching.fuzzy_best(df, "q", ("t", "a"), ("t2", "a2"), ["n"])
    prepared = matching.fuzzy_best(df, "q", ("t_p", "a_p"), ("t2_p", "a2_p"), ["n"], prepared=True)
    assert sorted(map(tuple, prepared.collect())) == sorted(map(tuple, plain.collect()))
