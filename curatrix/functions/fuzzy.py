"""String similarity of candidate pairs, as Arrow UDFs: Spark has neither measure. Use them after an equi-join, never on all pairs."""

from __future__ import annotations

from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import fuzzy_key, title_core


@lru_cache(maxsize=1 << 16)  # titles and artists recur from batch to batch
def _matching(x: str, y: str) -> float:
    return 0.0 if not x or not y else 1.0 if x == y else SequenceMatcher(None, x, y).ratio()


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity: twice the matching blocks' length over both lengths; 0 where either is blank."""
    return pd.Series([_matching(x or "", y or "") for x, y in zip(a, b, strict=True)])


@F.pandas_udf(T.DoubleType())
def indel_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Twice the longest common subsequence over both lengths; 1 for two blanks."""

    def one(x: str, y: str) -> float:
        if not x and not y:
            return 1.0
        ahead = {c: 0 for c in x}
        for k, c in enumerate(x):
            ahead[c] |= 1 << k
        row, full = (1 << len(x)) - 1, (1 << len(x)) - 1
        for c in y:  # bit-parallel: zeros of row are the subsequence's ends
            hit = row & ahead.get(c, 0)
            row = (row + hit | row - hit) & full
        return 2 * (len(x) - row.bit_count()) / (len(x) + len(y))

    return pd.Series([one(x or "", y or "") for x, y in zip(a, b, strict=True)])


def title_similarity(x: Column, y: Column) -> Column:
    """Of two title cores: 1 if equal, .99 where one contains the other, else their ratio; 0 for blanks."""
    return F.when((x == "") | (y == ""), 0.0).when(x == y, 1.0).when(x.contains(y) | y.contains(x), 0.99).otherwise(sequence_ratio(x, y))


def artist_similarity(x: Column, y: Column) -> Column:
    """Of two artist keys: at least .95 where one contains the other; .5 if x is blank."""
    ratio = sequence_ratio(x, y)
    return F.when(x == "", 0.5).when(y == "", 0.0).when(x == y, 1.0).when(x.contains(y) | y.contains(x), F.greatest(ratio, F.lit(0.95))).otherwise(ratio)


def core_score(title: Column, artist: Column, other_title: Column, other_artist: Column) -> Column:
    """match_score of title cores and artist keys made before."""
    t, a = title_similarity(title, other_title), artist_similarity(artist, other_artist)
    same = (artist != "") & (artist == other_artist)
    return F.least(F.lit(1.0), 0.72 * t + 0.28 * a + F.when(t > 0.97, 0.04).otherwise(0.0) + F.when(a > 0.9, 0.03).otherwise(0.0) + F.when(same, 0.05).otherwise(0.0))


def match_score(title: Column, artist: Column, other_title: Column, other_artist: Column) -> Column:
    """Weighted similarity of two rows, with bonuses for close titles and artists, 1 at most."""
    return core_score(title_core(title), fuzzy_key(artist), title_core(other_title), fuzzy_key(other_artist))
