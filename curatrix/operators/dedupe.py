"""Duplicate groups: finding, classifying, choosing a keeper and folding rows together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean, compact_key, nonblank, or_null
from ..functions.values import listed, year_in
from .rows import with_rank

#: Titles that name a version, and albums that collect older work.
VERSION_WORDS = r"(?i)\b(live|remix|remaster(?:ed)?|edit|version|mix|demo|instrumental|karaoke|cover|extended|acoustic|alternate|night version|club|single version|album version)\b"
COMPILATION_WORDS = r"(?i)\b(greatest hits|best of|collection|anthology|essential|hits|compilation|ultimate|gold)\b"


def duplicate_groups(df: DataFrame, identity: Column, row_id: str) -> DataFrame:
    """(identity, group_size, row_id): the members of the identities that several rows share, a row each. Sizes are counted before the join, so no task or row holds a group."""
    keyed = df.select(identity.alias("identity"), row_id)
    return keyed.join(group_sizes(keyed, F.col("identity")), "identity").select("identity", "group_size", row_id)


def group_sizes(df: DataFrame, identity: Column) -> DataFrame:
    """(identity, group_size) of the identities that several rows share."""
    return df.groupBy(identity.alias("identity")).agg(F.count("*").alias("group_size")).where("group_size > 1")


def with_group_size(df: DataFrame, keys: list[str]) -> DataFrame:
    """df with the size of each row's group. Sizes are counted before the join, so that a large group's rows stay apart."""
    sizes = df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(F.count("*").alias("group_size"))
    on = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    return df.join(sizes, on, "left").drop(*[f"_key_{k}" for k in keys])


def classified(df: DataFrame, keys: list[str], album: str, duration: str, track_id: str, year: Column | None = None) -> DataFrame:
    """Each group's kind: one track, probably one, alternate releases, or for review."""
    values = lambda c: F.count_distinct(F.nullif(c, F.lit("")))
    years = F.count_distinct(year if year is not None else year_in(F.col(album)))
    counts = df.groupBy(*keys).agg(F.count("*").alias("group_size"), values(compact_key(F.col(album))).alias("albums"), values(compact_key(F.col(duration))).alias("durations"), values(clean(F.col(track_id))).alias("track_ids"), years.alias("years"), F.bool_or(clean(F.col(album)).rlike(COMPILATION_WORDS)).alias("has_hits"))
    kind = F.when(F.col("track_ids") == 1, "true_duplicate_same_track").when((F.col("albums") <= 1) & (F.col("durations") <= 1), "probable_true_duplicate").when(F.col("has_hits"), "album_alternate_greatest_hits_present").when((F.col("years") > 1) | (F.col("albums") > 1), "album_or_release_alternate").otherwise("needs_review")
    return counts.where("group_size > 1").withColumn("kind", kind)


def safe_groups(df: DataFrame, keys: list[str], title: str, duration: Column, spread: int = 3) -> DataFrame:
    """(keys, is_safe) of groups of two and more: no version words, and durations close together."""
    apart = F.coalesce(F.max(duration) - F.min(duration) > spread, F.lit(False))
    return df.groupBy(*keys).agg(F.count("*").alias("group_size"), (~F.bool_or(clean(F.col(title)).rlike(VERSION_WORDS)) & ~apart).alias("is_safe")).where("group_size > 1")


def keeper_order(album: Column, year: Column, completeness: Column, title: Column) -> list[Column]:
    """Original albums before compilations, early before late, with an album before without, full before sparse, then by title."""
    return [clean(album).rlike(COMPILATION_WORDS).asc(), F.coalesce(year, F.lit(9999)).asc(), (clean(album) == "").asc(), completeness.desc(), clean(title).asc()]


def with_keeper(df: DataFrame, keys: list[str], order: list[Column], row_id: str) -> DataFrame:
    """df with keep_rank in its group (1: the keeper) and keeper_id."""
    ranked = with_rank(df, keys, [*order, F.col(row_id).asc()], "keep_rank").withColumn("keep_rank", F.col("keep_rank").cast("int"))
    keepers = ranked.where("keep_rank = 1").select(*[F.col(k).alias(f"_keep_{k}") for k in keys], F.col(row_id).alias("keeper_id"))
    on = [F.col(k).eqNullSafe(F.col(f"_keep_{k}")) for k in keys]
    return ranked.join(keepers, on).drop(*[f"_keep_{k}" for k in keys])


def folded(df: DataFrame, keys: list[str], rank: str, scalars: list[str], lists: list[str], separators: str = ";") -> DataFrame:
    """One row a group: each scalar's first nonblank value by rank, each list's values in order of rank."""
    first = [F.min_by(or_null(F.col(c)), F.when(nonblank(F.col(c)), F.col(rank))).alias(c) for c in scalars]

    def union(c: str) -> Column:
        cells = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), listed(F.col(c), separators).alias("v"))))
        return F.array_join(F.array_distinct(F.flatten(F.transform(cells, lambda x: x["v"]))), "; ").alias(c)

    return df.groupBy(*keys).agg(F.count("*").alias("group_size"), *first, *[union(c) for c in lists])


def safe_merge(df: DataFrame, keys: list[str], row_id: str, title: str, duration: Column, order: list[Column], scalars: list[str], lists: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(merged rows of safe groups, rows they absorbed, rows of groups for review). Rows of no group are in none of these."""
    groups = safe_groups(df, keys, title, duration)
    ranked = with_keeper(df.join(groups, keys), keys, order, row_id)
    safe = ranked.where("is_safe")
    merged = folded(safe, [*keys, "keeper_id"], "keep_rank", scalars, lists)
    return merged, safe.where("keep_rank > 1").select(row_id, "keeper_id"), ranked.where("NOT is_safe").select(row_id, *keys, "keeper_id", "keep_rank")


def deduped_with_sources(df: DataFrame, keys: list[Column], order: list[str], fill: list[str], sources: list[str]) -> DataFrame:
    """One row for each set of keys: first filled values by order, and each source column's distinct values in order."""
    named = [k.alias(f"_k{i}") for i, k in enumerate(keys)]
    place = F.struct(*[F.col(c) for c in order])
    ordered = lambda c: F.array_join(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(nonblank(F.col(c)), F.struct(place.alias("o"), clean(F.col(c)).alias("v"))))), lambda x: x["v"])), "; ").alias(c)
    return df.groupBy(*named).agg(*[F.min_by(or_null(F.col(c)), F.when(nonblank(F.col(c)), place)).alias(c) for c in fill], *[ordered(c) for c in sources], F.count("*").alias("n")).drop(*[f"_k{i}" for i in range(len(keys))])


def bridge(df: DataFrame, row_id: str, values: Column, name: str) -> DataFrame:
    """Distinct (row, value) of a multi-valued cell."""
    return df.select(row_id, F.explode(values).alias(name)).dropDuplicates([row_id, name])


def fold_membership(df: DataFrame, members: DataFrame, row_id: str, value: str, cell: str) -> DataFrame:
    """df with each row's member values (sorted) added to a multi-valued cell."""
    gained = members.groupBy(F.col(row_id).alias("_row")).agg(F.sort_array(F.collect_set(value)).alias("_gained"))
    merged = F.array_join(F.array_distinct(F.concat(listed(F.col(cell)), F.coalesce("_gained", F.array().cast("array<string>")))), "; ")
    return df.join(gained, F.col(row_id) == F.col("_row"), "left").withColumn(cell, merged).drop("_row", "_gained")


