"""Projections, filters, predicates, ordering and set operations on whole rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean, compact_key, is_blank, nonblank, or_null, search_text, text_of
from ..sources.session import written

# --- projections

def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Only the mapped columns, by their new names."""
    return df.select([F.col(f"`{a}`").alias(b) for a, b in names.items()])


def widened(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with the columns it lacks, blank."""
    return df.withColumns({c: F.lit("") for c in columns if c not in df.columns}) if set(columns) - set(df.columns) else df


def clean_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lstrip("\ufeff").replace(" ", "_") for c in df.columns])


def to_observations(df: DataFrame, ids: list[str], columns: list[str]) -> DataFrame:
    """A row for each nonblank cell: ids, field_name, field_value."""
    text = df.select(*ids, *[text_of(F.col(f"`{c}`")).alias(c) for c in columns])
    return text.unpivot(ids, columns, "field_name", "field_value").where(nonblank(F.col("field_value")))


def exploded_structs(df: DataFrame, keep: list[str], structs: list[Column]) -> DataFrame:
    """One row for each struct beside the kept columns, as for the link rows of a record."""
    return df.select(*keep, F.inline(F.array(*structs)))


def payload_rows(df: DataFrame, payload: str, schema: str, columns: dict[str, Column]) -> DataFrame:
    """JSON payloads as flat rows. columns name fields of `p`, the parsed payload."""
    return df.withColumn("p", F.from_json(F.col(payload), schema)).withColumns(columns).drop("p")


# --- filters

def with_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose key is listed; a key listed twice counts once."""
    return df.join(ids.select(F.col(ids.columns[0]).alias("_listed")), F.col(key) == F.col("_listed"), "left_semi")


def search_terms(query: str, most: int = 8) -> list[str]:
    import re

    from ..functions.text import searched, shown

    return [t for t in re.split(r"[^\w]+", searched(shown(query))) if len(t) > 1][:most]


def vibe_search(df: DataFrame, query: str, columns: list[str], *, prepared: bool = False) -> DataFrame:
    """Rows in which every term of the query is part of some column. prepared: the columns hold search text already."""
    key = (lambda c: F.coalesce(F.col(c), F.lit(""))) if prepared else (lambda c: search_text(F.col(c)))
    for term in search_terms(query):
        df = df.where(reduce(lambda a, b: a | b, [key(c).contains(term) for c in columns]))
    return df


def grid_filter(df: DataFrame, text: str | None = None, columns: list[str] | None = None, among: dict[str, list] | None = None, between: dict[str, tuple] | None = None, *, literal: bool = False) -> DataFrame:
    """A pattern in any of the columns, listed values, and ranges (which drop nulls)."""
    if text:
        found = [(F.lower(text_of(F.col(c))).contains(text.lower()) if literal else text_of(F.col(c)).rlike(f"(?i){text}")) for c in columns or []]
        df = df.where(reduce(lambda a, b: a | b, found))
    for c, options in (among or {}).items():
        df = df.where(F.col(c).isin(options))
    for c, (low, high) in (between or {}).items():
        df = df.where(F.col(c).between(low, high))
    return df


def lacks_all(*columns: Column) -> Column:
    """None of the columns is filled."""
    return ~reduce(lambda a, b: a | b, [nonblank(c) for c in columns])


def lacks_any(*columns: Column) -> Column:
    return reduce(lambda a, b: a | b, [is_blank(c) for c in columns])


def unverified(title: Column, artist: Column, flags: list[Column]) -> Column:
    """Named rows that no source has verified."""
    return nonblank(title) & nonblank(artist) & ~reduce(lambda a, b: a | b, [F.lower(clean(f)) == "yes" for f in flags])


def approved(decision: Column, required: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, [nonblank(c) for c in required], F.lower(clean(decision)) == "approve")


def loose_hit(title: Column, artist: Column, other_title: Column, other_artist: Column) -> Column:
    """Artists equal or one holds the other's first 8 letters; a title within the other, or one holds the other's first 10."""
    t, a, u, b = (F.lower(clean(c)) for c in (title, artist, other_title, other_artist))
    artists = (a == b) | b.contains(F.substring(a, 1, 8)) | a.contains(F.substring(b, 1, 8))
    return artists & (u.contains(t) | t.contains(u) | u.contains(F.substring(t, 1, 10)))


def compact_match(title: Column, artist: Column, wanted_title: Column, wanted_artist: Column) -> Column:
    """Equal compact keys; a blank wanted artist fits all."""
    return (compact_key(title) == compact_key(wanted_title)) & ((compact_key(wanted_artist) == "") | (compact_key(artist) == compact_key(wanted_artist)))


# --- ordering

def page(df: DataFrame, order: list, limit: int, offset: int = 0) -> DataFrame:
    """One page in order; the order should end in a unique key."""
    return df.orderBy(*order).offset(max(0, offset)).limit(min(max(1, limit), 1000))


def bucket_order(bucket: Column, order: list[str]) -> Column:
    """Place of a bucket in a fixed order, unknown ones last."""
    return reduce(lambda c, k: F.when(bucket == order[k], k + 1).otherwise(c), range(len(order)), F.lit(len(order) + 1))


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def row_slice(df: DataFrame, number: str, start: int = 0, stop: int | None = None, limit: int | None = None) -> DataFrame:
    """Rows by their number: from start, before stop, at most limit."""
    end = min(x for x in (stop, start + limit if limit is not None else None, 1 << 62) if x is not None)
    return df.where((F.col(number) >= start) & (F.col(number) < end))


def with_rank(df: DataFrame, keys: list[str], order: list, name: str) -> DataFrame:
    """df with each row's place (from 1) in its key's order, also where one key has most rows: rows are dealt by ranges of key and order,
    numbered in each range, and a key that runs on from one range to the next goes on counting. order should be total within a key."""
    ordered = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(*keys, *ordered).withColumn("_range", F.spark_partition_id())
    ranged = written(ranged.withColumn("_in", F.row_number().over(Window.partitionBy("_range", *keys).orderBy(*ordered))))  # written once: another evaluation may draw other ranges
    named = lambda d: d.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)])
    key = F.struct(*[F.col(k).alias(k) for k in keys])
    ends = ranged.groupBy("_range").agg(F.min(key).alias("a"), F.max(key).alias("b"))  # two keys a range can be in others too
    edge = named(ends.select(F.explode(F.array("a", "b")).alias("k")).select("k.*").distinct())
    sizes = ranged.join(F.broadcast(edge), same, "left_semi").groupBy("_range", *keys).count()
    before = F.sum("count").over(Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.withColumn("_before", before).where("_before > 0")
    offsets = offsets.select(F.col("_range").alias("_r"), "_before", *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)])  # two rows a range at most
    joined = ranged.join(F.broadcast(offsets), same & (F.col("_range") == F.col("_r")), "left")
    return joined.withColumn(name, F.col("_in") + F.coalesce("_before", F.lit(0))).drop("_range", "_in", "_r", "_before", *[f"_key{i}" for i in range(len(keys))])


def numbered_groups(groups: DataFrame, order: list[str], prefix: str, name: str = "group_id") -> DataFrame:
    """groups (one row each) with PREFIX_0001 and so on in order: counted in ranges, no global window."""
    ranged = groups.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).withColumn("_in", F.row_number().over(Window.partitionBy("_range").orderBy(*order)))
    ranged = written(ranged)
    sizes = ranged.groupBy("_range").count().withColumn("_before", F.coalesce(F.sum("count").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select(F.col("_range").alias("_r"), "_before")
    return ranged.join(F.broadcast(sizes), F.col("_range") == F.col("_r")).withColumn(name, F.format_string(prefix + "_%04d", F.col("_before") + F.col("_in"))).drop("_range", "_in", "_r", "_before")


# --- sets

def union_open(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; a column that one lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def multiset_difference(left: DataFrame, right: DataFrame, signature: list[str], order: list) -> DataFrame:
    """Rows of left beyond as many of the same signature as right has, the last ones in order."""
    have = right.groupBy(*[F.col(s).alias(f"_{s}") for s in signature]).agg(F.count("*").alias("_have"))
    numbered = with_rank(left, signature, order, "_n")
    on = reduce(lambda a, b: a & b, [F.col(s).eqNullSafe(F.col(f"_{s}")) for s in signature])
    return numbered.join(have, on, "left").where(F.col("_n") > F.coalesce("_have", F.lit(0))).select(*left.columns)


def keys_only_in(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), keys, "left_anti")


def keys_in_both(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.select(*keys).intersect(right.select(*keys))


def disjoint(left: list[Column], right: list[Column]) -> Column:
    """No filled value of one side is on the other."""
    return ~F.coalesce(F.arrays_overlap(F.array_compact(F.array(*[or_null(c) for c in left])), F.array_compact(F.array(*[or_null(c) for c in right]))), F.lit(False))


def apart(df: DataFrame, special: Column, made: Callable[[DataFrame], DataFrame], plain: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """made of the special rows and plain of all others, in one table: rows that need no UDF go through none. df is read twice."""
    hit = F.coalesce(special, F.lit(False))
    return made(df.where(hit)).unionByName(plain(df.where(~hit)))
