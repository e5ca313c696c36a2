"""Joins of strings by similarity where no list of candidates is given: q-gram prefixes find every pair that can reach a ratio.

A ratio of two strings (twice what matches over both lengths) is at most twice their longest common subsequence over both lengths.
So strings of n and m characters with ratio `least` and more have common = least * (n + m) / 2 characters in order: lengths are
within (2 - least) / least of each other, and they share that many characters. Of the n - 1 pairs of neighbouring characters, each
character that one string lacks breaks two, and each that the other has besides breaks one, so they share 3 * common - n - m - 1 (repeats
numbered). Since m is least * n / (2 - least) at least, the rarest few pairs of each string, all but as many as it must share, plus one, have one
in common: these prefixes are joined. Strings too short for a sure pair are joined by single characters in the same way.
Candidates must then share as many pairs and characters as their two lengths ask for, all inside Spark; only what is left goes to the
ratio itself. No pair is lost; texts are distinct before they are joined, so that copies cost nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fuzzy import core_score, sequence_ratio
from ..functions.text import fuzzy_key, or_null, title_core
from ..sources.session import written

#: Guards bounds against the rounding of doubles.
EPS = 1e-9
NO_TOKENS = "array<string>"


def sure_pairs(n: Column, least: float) -> Column:
    """Pairs of characters that a string of n shares at least with any other of that ratio."""
    return F.ceil(n * (3 * least - 2) / (2 - least) - 1 - EPS)


def tokens_of(table: DataFrame) -> DataFrame:
    """text, n, token: of distinct texts every pair of neighbouring characters and every character, repeats numbered."""
    chars = F.split("text", "")
    base = table.select("text", F.char_length("text").alias("n"), chars.alias("_c"))
    two = F.when(F.col("n") >= 2, F.zip_with(F.slice("_c", 1, F.col("n") - 1), F.slice("_c", 2, F.greatest(F.col("n") - 1, F.lit(0))), lambda a, b: F.concat(a, b))).otherwise(F.array().cast(NO_TOKENS))
    grams = base.select("text", "n", F.explode(F.concat(two, "_c")).alias("_g")).groupBy("text", "n", "_g").agg(F.count("*").cast("int").alias("_k"))
    return grams.select("text", "n", (F.char_length("_g") == 2).alias("two"), F.explode(F.transform(F.sequence(F.lit(1), F.col("_k")), lambda k: F.concat(k.cast("string"), F.lit(":"), F.col("_g")))).alias("token"))


def gram_table(texts: DataFrame, least: float) -> DataFrame:
    """Of distinct texts (column text): n, pairs and ones (all, numbered, rarest first) and prefix (what of them is joined)."""
    tokens = tokens_of(texts)
    often = tokens.groupBy("token").agg(F.count("*").alias("_df"))
    listed = tokens.join(often, "token").groupBy("text", "n").agg(F.sort_array(F.collect_list(F.struct("_df", "token", "two"))).alias("_t"))  # one text's tokens
    some = lambda two: F.transform(F.filter("_t", lambda x: x["two"] == two), lambda x: x["token"])
    rows = listed.select("text", "n", some(True).alias("pairs"), some(False).alias("ones"))
    n, none = F.col("n"), F.array().cast(NO_TOKENS)
    first = lambda c, shared: F.slice(c, 1, F.greatest(F.size(c) - shared + 1, F.lit(0)).cast("int"))
    head = F.when(sure_pairs(n, least) >= 1, first("pairs", sure_pairs(n, least))).otherwise(none)
    # a text without a sure pair, and all of lengths that it may be similar to
    unsure = n * least / (2 - least) <= (2 - least) / (3 * least - 2) + EPS if 3 * least > 2 + EPS else F.lit(True)
    return rows.select("text", "n", "pairs", "ones", F.concat(head, F.when(unsure, first("ones", F.ceil(n * least / (2 - least) - EPS))).otherwise(none)).alias("prefix"))


def both_sides(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Distinct texts (and by) with the sides that have them: _l, _r."""
    sides = left.select("text", *by, F.lit(True).alias("_l"), F.lit(False).alias("_r")).unionByName(right.select("text", *by, F.lit(False).alias("_l"), F.lit(True).alias("_r")))
    return sides.where(F.col("text") != "").groupBy("text", *by).agg(F.bool_or("_l").alias("_l"), F.bool_or("_r").alias("_r"))


def candidate_texts(left: DataFrame, right: DataFrame, least: float, by: str | None = None) -> DataFrame:
    """(a, b): every two texts of left and right (column text) that pass the bounds of a ratio of at least least; empty texts are in none. by: a column in which they must be equal."""
    if not 0 < least <= 1:
        raise ValueError("least must be over 0 and at most 1")
    keys = [by] if by else []
    sides = both_sides(left, right, keys)
    table = gram_table(sides.select("text").distinct(), least).join(sides, "text")
    posting = lambda side, p: table.where(side).select(F.explode("prefix").alias("token"), *keys, F.col("text").alias(p), *[F.col(c).alias(f"{c}_{p}") for c in ("n", "pairs", "ones", "prefix")])
    both = posting("_l", "a").join(posting("_r", "b"), ["token", *keys])
    n = F.col("n_a") + F.col("n_b")
    common = least * n / 2 - EPS
    first = F.get(F.array_intersect("prefix_a", "prefix_b"), F.lit(0)) == F.col("token")  # each pair once, at the first token that both have
    shared = lambda c: F.size(F.array_intersect(f"{c}_a", f"{c}_b"))
    return both.where(F.least("n_a", "n_b") >= common).where(first & (shared("ones") >= common) & (shared("pairs") >= 3 * common - n - 1)).select("a", "b", *keys)


def similar_texts(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """(a, b, ratio): every two texts (column text) of left and right with a sequence ratio of at least least."""
    return candidate_texts(left, right, least).withColumn("ratio", sequence_ratio("a", "b")).where(F.col("ratio") >= least)


def containing_texts(left: DataFrame, right: DataFrame) -> DataFrame:
    """(a, b): the texts of left and right of which one contains the other: the shorter one's rarest pair of characters (or its one character) is in the longer."""
    sides = both_sides(left, right, [])
    tokens = tokens_of(sides).where(F.col("token").startswith("1:")).join(sides, "text")
    often = tokens.groupBy("token").agg(F.count("*").alias("_df"))
    rare = tokens.where(F.col("two") | (F.col("n") == 1)).join(often, "token").groupBy("text", "_l", "_r").agg(F.min(F.struct("_df", "token")).getField("token").alias("token"))
    lies_in = lambda short, long: rare.where(short).select("token", F.col("text").alias("s")).join(tokens.where(long).select("token", F.col("text").alias("l")), "token").where(F.col("l").contains(F.col("s")))
    found = lies_in("_l", "_r").select(F.col("s").alias("a"), F.col("l").alias("b")).unionByName(lies_in("_r", "_l").select(F.col("l").alias("a"), F.col("s").alias("b")))
    return found.distinct()


#: Of a match_score: the weights of title and artist, the bonuses of a close and of an equal artist, and over what an artist is close.
TITLE, ARTIST, CLOSE, EQUAL, CLOSE_ARTIST = 0.72, 0.28, 0.03, 0.05, 0.9
#: The bonus of a title over CLOSE_TITLE.
CLOSE_TITLE, TITLE_BONUS = 0.97, 0.04


def fuzzy_join(queries: DataFrame, query_id: str, query: tuple[str, str], results: DataFrame, result_id: str, result: tuple[str, str], least: float) -> DataFrame:
    """(query_id, result_id, match_score) of each query's best result among all results, if its match_score reaches least; equal scores by result id.

    query, result: columns of title and artist. A title is found among all that contain it or it contains, among all with the ratio that
    is needed beside an artist that is not close, and among those of close artists with the lower ratio that is needed there. Rows of one
    title and artist are scored once, for the least id."""
    far, near = ((least - ARTIST * CLOSE_ARTIST) / TITLE, (least - ARTIST - CLOSE - EQUAL) / TITLE)
    far = far if far <= CLOSE_TITLE else max(CLOSE_TITLE, (least - ARTIST * CLOSE_ARTIST - TITLE_BONUS) / TITLE)
    if near <= 0:
        raise ValueError(f"least must be over {ARTIST + CLOSE + EQUAL}")
    side = lambda df, i, t, a, p: df.select(i, or_null(F.col(t)).alias(f"{p}_title"), or_null(F.col(a)).alias(f"{p}_artist"))
    q = side(queries, query_id, *query, "q").withColumns({"a": title_core(F.col("q_title")), "x": fuzzy_key(F.col("q_artist"))})
    asked = written(q.groupBy("a", "x", "q_title", "q_artist").agg(F.count("*").alias("_n")))
    r = side(results, result_id, *result, "r").groupBy("r_title", "r_artist").agg(F.min(result_id).alias(result_id))
    r = written(r.withColumns({"b": title_core(F.col("r_title")), "y": fuzzy_key(F.col("r_artist"))}))
    text = lambda df, c, *more: df.select(F.col(c).alias("text"), *more).distinct()
    anywhere = containing_texts(text(asked, "a"), text(r, "b"))
    if far <= 1:
        anywhere = anywhere.unionByName(candidate_texts(text(asked, "a"), text(r, "b"), far)).distinct()
    artists = [text(asked, "x"), text(r, "y")]
    close = candidate_texts(*artists, CLOSE_ARTIST).unionByName(containing_texts(*artists)).distinct().toDF("x", "y")
    beside = candidate_texts(text(asked.join(close, "x"), "a", "y"), text(r, "b", "y"), near, "y").toDF("a", "b", "y") if near <= 1 else None
    columns = ["q_title", "q_artist", "a", "x", "b", "y", result_id]
    pairs = asked.join(anywhere, "a").join(r, "b").select(columns)
    if beside is not None:
        pairs = pairs.unionByName(asked.join(close, "x").join(beside, ["a", "y"]).join(r, ["b", "y"]).select(columns)).distinct()
    scored = pairs.withColumn("match_score", core_score(*[F.col(c) for c in "axby"])).where(F.col("match_score") >= least)
    best = scored.groupBy("q_title", "q_artist").agg(F.min(F.struct((-F.col("match_score")).alias("s"), F.col(result_id).alias("i"))).alias("_best"))
    back = q.join(best.toDF("_t", "_a", "_best"), F.col("q_title").eqNullSafe(F.col("_t")) & F.col("q_artist").eqNullSafe(F.col("_a")))
    return back.select(query_id, F.col("_best.i").alias(result_id), (-F.col("_best.s")).alias("match_score"))
