"""Joins on match keys: by several keys, waterfalls, unique matches and scored candidates.

No operator here compares all pairs: candidates always come from an equi-join on a key.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fuzzy import core_score, match_score
from ..functions.text import fuzzy_key, search_text, song_key
from ..functions.values import agreement, weighted
from ..sources.session import spread, written

#: Points (in hundredths) of agreement by field, and the least score (in thousandths) of each verdict.
TITLE_POINTS = {"exact": 55, "partial": 45}
ARTIST_POINTS = {"exact": 35, "partial": 25}
ALBUM_POINTS = {"exact": 10, "partial": 5, "missing": 3}
MATCHED, NEEDS_REVIEW = 900, 720


def exploded(df: DataFrame, keys: Column, name: str = "match_key") -> DataFrame:
    """A row for each key of an array."""
    return df.withColumn(name, F.explode(keys))


#: Pairs that one part of a spread join makes at most, about (a task: twice as many on average), and copies of rows that one task deals to parts.
PAIRS_A_PART, COPIES_A_TASK = 4_000_000, 1_000_000


def spread_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """left and right joined by key. Each is read twice, so callers write what is costly to make.

    A key's pairs are cut into a grid: its rows on either side are dealt to slices, and each slice goes to all of the other side. Tasks grow in number as pairs do, so the longest does not;
    a row is copied once for some sqrt(PAIRS_A_PART) of its pairs."""
    side, n = math.isqrt(PAIRS_A_PART), int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count = lambda df, name: df.groupBy(key).agg(F.count("*").alias(name))
    slices = {"_xs": F.ceil(F.col("_l") / side), "_ys": F.ceil(F.col("_r") / side)}
    cut = written(count(left, "_l").join(count(right, "_r"), key).withColumns(slices))
    total = lambda a, b: F.coalesce(F.sum(F.col(a).cast("double") * b), F.lit(0.0))
    n_pairs, more_left, more_right = cut.agg(total("_l", F.col("_r")), total("_l", F.col("_ys") - 1), total("_r", F.col("_xs") - 1)).first()
    large = F.broadcast(cut.where("_xs > 1 OR _ys > 1").select(key, "_xs", "_ys"))  # one key for each `side` rows at most

    def dealt(df: DataFrame, more: float, own: str, owns: str, other: str, others: str) -> DataFrame:
        if more > COPIES_A_TASK:
            df = df.repartition(max(n, math.ceil(more / COPIES_A_TASK)))
        many = lambda c: F.coalesce(c, F.lit(1).cast("bigint"))
        placed = df.join(large, key, "left").withColumns({own: F.pmod(F.xxhash64(*df.columns), many(owns)), other: F.explode(F.sequence(F.lit(0).cast("bigint"), many(others) - 1))})
        return placed.drop("_xs", "_ys").repartition(n_tasks, key, "_x", "_y")

    n_tasks = max(n, math.ceil(n_pairs / (2 * PAIRS_A_PART)))  # stated, since parts are small in bytes and would be put together again
    return dealt(left, more_left, "_x", "_xs", "_y", "_ys").join(dealt(right, more_right, "_y", "_ys", "_x", "_xs").hint("merge"), [key, "_x", "_y"]).drop("_x", "_y")


def pending(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys are not done yet."""
    return df.join(done.select(*keys).distinct(), keys, "left_anti")


def without_any_key(df: DataFrame, row_id: str, keys: Column, excluded: DataFrame, key: str) -> DataFrame:
    """The rows none of whose keys is excluded."""
    hit = exploded(df.select(row_id, keys.alias("_keys")), F.col("_keys"), "_key").join(excluded.select(F.col(key).alias("_key")), "_key", "left_semi").select(row_id).distinct()
    return df.join(hit, row_id, "left_anti")


def fallback_match(df: DataFrame, index: DataFrame, exact: Column, fallback: Column, key: str, value: str) -> DataFrame:
    """df with the index's value by its exact key, else by its fallback key. index has one row for each key."""
    index = index.select(F.col(key), F.col(value))
    first, second = index.toDF("_k1", "_v1"), index.toDF("_k2", "_v2")
    keyed = df.withColumns({"_exact": exact, "_fallback": fallback})
    joined = keyed.join(first, F.col("_exact") == F.col("_k1"), "left").join(second, F.col("_fallback") == F.col("_k2"), "left")
    return joined.withColumn(value, F.coalesce("_v1", "_v2")).drop("_exact", "_fallback", "_k1", "_k2", "_v1", "_v2")


def alias_match(queries: DataFrame, query_id: str, query_keys: Column, index: DataFrame, index_id: str, index_keys: Column) -> DataFrame:
    """queries with match_status (matched, ambiguous, unmatched), hits, and the index id where there is just one."""
    left = exploded(queries.select(query_id, query_keys.alias("_keys")), F.col("_keys"), "_key").select(query_id, "_key").distinct()
    right = exploded(index.select(F.col(index_id).alias("_hit"), index_keys.alias("_keys")), F.col("_keys"), "_key").select("_hit", "_key").distinct()
    # of each key only how many ids it has, and the extreme ones: a key that many rows share is never multiplied out
    ids = right.groupBy("_key").agg(F.min("_hit").alias("_least"), F.max("_hit").alias("_most"))
    found = left.join(ids, "_key").groupBy(query_id).agg(F.min("_least").alias("_least"), F.max("_most").alias("_most"))
    one = F.col("_least") == F.col("_most")
    status = F.when(F.col("_least").isNull(), "unmatched").when(one, "matched").otherwise("ambiguous")
    return queries.join(found, query_id, "left").withColumns({"match_status": status, f"matched_{index_id}": F.when(one, F.col("_least"))}).drop("_least", "_most")


def all_variant_hits(queries: DataFrame, query_id: str, query_keys: Column, index: DataFrame, index_id: str, index_keys: Column) -> DataFrame:
    """Distinct (query id, index id) that share any key.

    Sets of keys are matched, each once, and then give way to the ids that have them: no pair of ids is made twice or shuffled. An id's keys are put into one row."""
    by_id = lambda df, i, keys, name: spread(df).select(i, keys.alias("_keys")).groupBy(i).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("_keys")))).alias(name))
    left, right = written(by_id(queries, query_id, query_keys, "_q")), written(by_id(index, index_id, index_keys, "_i"))
    one = lambda df, name: exploded(df.select(name).distinct(), F.col(name), "_key")
    sets = one(left, "_q").join(one(right, "_i"), "_key").select("_q", "_i").distinct()
    return spread_join(written(left.join(sets, "_q").select(query_id, "_i")), right, "_i").select(query_id, index_id)


def unambiguous(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key no other row has."""
    sole = df.groupBy(*[F.col(k).alias(f"_sole_{k}") for k in keys]).agg(F.count("*").alias("_n")).where("_n = 1")  # counted before the join: a key of many rows is never held together
    return df.join(sole, [F.col(k).eqNullSafe(F.col(f"_sole_{k}")) for k in keys], "left_semi")


def match_waterfall(df: DataFrame, row_id: str, title: Column, artist: Column, official: DataFrame, official_id: str, official_title: Column, official_artist: Column, key=song_key) -> DataFrame:
    """df with official_match_status and official_id: exact title and artist (one, several), title alone (one, several), or none.

    The official side is rolled up by key before the join, so frequent titles are not multiplied out."""
    base = official.select(F.col(official_id).alias("_id"), key(official_title).alias("_t"), key(official_artist).alias("_a"))
    both = base.groupBy("_t", "_a").agg(F.count("*").alias("_n_both"), F.min("_id").alias("_id_both"))
    alone = base.groupBy(F.col("_t").alias("_t1")).agg(F.count("*").alias("_n_title"), F.min("_id").alias("_id_title"))
    keyed = df.withColumns({"_qt": key(title), "_qa": key(artist)})
    joined = keyed.join(both, (F.col("_qt") == F.col("_t")) & (F.col("_qa") == F.col("_a")), "left").join(alone, F.col("_qt") == F.col("_t1"), "left")
    ladder = [(F.col("_n_both") == 1, "matched_exact_title_artist", "_id_both"), (F.col("_n_both") > 1, "matched_exact_ambiguous", "_id_both"), (F.col("_n_title") == 1, "matched_title_only", "_id_title"), (F.col("_n_title") > 1, "matched_title_only_ambiguous", "_id_title")]
    status, found = F.lit("not_found"), F.lit(None)
    for condition, name, c in reversed(ladder):
        status, found = F.when(condition, name).otherwise(status), F.when(condition, F.col(c)).otherwise(found)
    return joined.withColumns({"official_match_status": status, "official_id": found}).drop("_qt", "_qa", "_t", "_a", "_t1", "_n_both", "_n_title", "_id_both", "_id_title")


def provider_scores(pairs: DataFrame, seed: dict[str, str], result: dict[str, str], key=search_text) -> DataFrame:
    """pairs with title_status, artist_status, album_status, score (thousandths) and verdict. seed, result: column names of title, artist and album.

    key: how values compare; give the identity for columns that hold search text already, made once a row before rows were paired."""
    status = {f: agreement(F.col(seed[f]), F.col(result[f]), key) for f in ("title", "artist", "album")}
    scored = pairs.withColumns({f"{f}_status": c for f, c in status.items()})
    points = weighted(F.col("title_status"), TITLE_POINTS) + weighted(F.col("artist_status"), ARTIST_POINTS) + weighted(F.col("album_status"), ALBUM_POINTS)
    scored = scored.withColumn("score", F.least(F.lit(1000), 10 * points))
    return scored.withColumn("verdict", F.when(F.col("score") >= MATCHED, "matched").when(F.col("score") >= NEEDS_REVIEW, "needs_review").otherwise("rejected"))


def integer_scores(pairs: DataFrame, query: dict[str, str], result: dict[str, str], key) -> DataFrame:
    """pairs with points: title 6 if equal, 4 if contained; artist the same; album 2; verified from 10 on."""
    def part(f: str) -> Column:
        a, b = key(F.col(query[f])), key(F.col(result[f]))
        return F.when((a == "") | (b == ""), 0).when(a == b, 6).when(a.contains(b) | b.contains(a), 4).otherwise(0)

    album = F.when((key(F.col(query["album"])) != "") & (key(F.col(query["album"])) == key(F.col(result["album"]))), 2).otherwise(0)
    return pairs.withColumn("points", part("title") + part("artist") + album).withColumn("verified", F.col("points") >= 10)


def fuzzy_best(pairs: DataFrame, query_id: str, query: tuple[str, str], result: tuple[str, str], order: list, *, prepared: bool = False) -> DataFrame:
    """Each query's best result with its match_score; equal scores by order. prepared: the columns hold title cores and artist keys already, made once a row before rows were paired."""
    score = core_score if prepared else match_score
    scored = pairs.withColumn("match_score", score(F.col(query[0]), F.col(query[1]), F.col(result[0]), F.col(result[1])))
    return scored.withColumn("_n", F.row_number().over(Window.partitionBy(query_id).orderBy(F.desc("match_score"), *order))).where("_n = 1").drop("_n")


def provider_waterfall(scored: DataFrame, query_id: str, *, enough: float = 0.97, least: float = 0.9, score: str = "match_score", candidate: str = "candidate_pos", provider: str = "provider_rank") -> DataFrame:
    """Each query's choice: the first candidate and provider whose score is enough, else the best that reaches least."""
    stop = F.when(F.col(score) >= enough, 0).otherwise(1)
    order = Window.partitionBy(query_id).orderBy(stop, F.when(stop == 0, F.col(candidate)), F.when(stop == 0, F.col(provider)), F.desc(score), candidate, provider)
    return scored.where(F.col(score) >= least).withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def two_source_status(primary: Column, secondary: Column) -> Column:
    """Verified if two sources say Yes."""
    yes = lambda c: F.lower(F.coalesce(c, F.lit(""))) == "yes"
    return F.when(yes(primary) & yes(secondary), "verified").when(yes(primary) | yes(secondary), "partially_verified").otherwise("unverified")


def choose_hit(pairs: DataFrame, query_id: str, agree: dict[str, tuple[str, str, int]], order: list) -> DataFrame:
    """Of several hits of a query the one with most points for agreeing fields (query column, hit column, points), the first of equals."""
    points = F.lit(0)
    for a, b, n in agree.values():
        points = points + F.when((fuzzy_key(F.col(a)) != "") & (fuzzy_key(F.col(a)) == fuzzy_key(F.col(b))), n).otherwise(0)
    return pairs.withColumn("hit_points", points).withColumn("_n", F.row_number().over(Window.partitionBy(query_id).orderBy(F.desc("hit_points"), *order))).where("_n = 1").drop("_n")


def cover_pairs(df: DataFrame, title: Column, artist: Column, row_id: str, wanted: Column | None = None) -> DataFrame:
    """Rows of one title by different artists, both directions. wanted: the rows whose covers are looked up (all)."""
    base = written(spread(df).select(F.col(row_id), song_key(title).alias("_t"), artist.alias("_a"), F.lower(artist).alias("_la")))
    other = base.toDF("cover_id", "_t", "cover_artist", "_lb")
    base = base.where(wanted) if wanted is not None else base
    found = spread_join(base, other, "_t").where(F.col("_la") != F.col("_lb"))
    return found.select(F.col(row_id).alias("original_id"), F.col("_t").alias("title_key"), F.col("_a").alias("original_artist"), "cover_id", "cover_artist")
