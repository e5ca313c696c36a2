"""Counts, quality reports and coverage. Each is one pass, or one grouped aggregate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean, display_text, is_blank, nonblank, or_null, text_of


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def group_counts(df: DataFrame, keys: list[str], most: int | None = None) -> DataFrame:
    """Rows of each key, the most frequent first, equal ones by key."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return counts if most is None else counts.orderBy(F.desc("n"), *keys).limit(most)


def bucket_counts(df: DataFrame, bucket: Column, name: str = "bucket") -> DataFrame:
    return df.groupBy(bucket.alias(name)).agg(F.count("*").alias("n"))


def missing_report(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row: how many rows each condition holds for, and all."""
    return df.agg(F.count("*").alias("n_rows"), *[F.count_if(c).alias(k) for k, c in checks.items()])


def blank_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*[F.count_if(is_blank(F.col(c))).alias(f"blank_{c}") for c in columns])


def verified_coverage(df: DataFrame, flags: dict[str, Column], ids: dict[str, Column]) -> DataFrame:
    """One row: rows verified by two sources or fewer, by each source, and with each identifier."""
    yes = {k: F.lower(clean(c)) == "yes" for k, c in flags.items()}
    count = reduce(lambda a, b: a + b, [F.when(c, 1).otherwise(0) for c in yes.values()])
    return df.agg(F.count("*").alias("n_rows"), F.count_if(count >= 2).alias("dual_verified"), F.count_if(count < 2).alias("under_verified"), *[F.count_if(c).alias(f"verified_{k}") for k, c in yes.items()], *[F.count_if(nonblank(c)).alias(f"with_{k}") for k, c in ids.items()])


def seen_rollup(df: DataFrame, key: str, stamp: str, sets: dict[str, str]) -> DataFrame:
    """Each key's rows, first and last time, and the sorted distinct values of some columns."""
    return df.groupBy(key).agg(F.count("*").alias("n"), F.min(stamp).alias("first_seen"), F.max(stamp).alias("last_seen"), *[F.sort_array(F.collect_set(c)).alias(name) for name, c in sets.items()])


def decade(c: Column) -> Column:
    """The decade of a year from 1900 to 2030, else null."""
    y = c.try_cast("double")
    return F.when(y.between(1900, 2030), (F.floor(y / 10) * 10).cast("int"))


def token_counts(df: DataFrame, tokens: Column, ignored: list[str], most: int, by: Column | None = None) -> DataFrame:
    """The most frequent tokens (of each group), equal ones by name."""
    rows = df.select(*([by.alias("grp")] if by is not None else []), F.explode(tokens).alias("token")).where(~F.col("token").isin(ignored) if ignored else F.lit(True))
    counts = rows.groupBy(*(["grp"] if by is not None else []), "token").agg(F.count("*").alias("n"))
    if by is None:
        return counts.orderBy(F.desc("n"), "token").limit(most)
    return counts.withColumn("place", F.row_number().over(Window.partitionBy("grp").orderBy(F.desc("n"), "token"))).where(F.col("place") <= most)


def value_counts(df: DataFrame, column: str, most: int = 20) -> DataFrame:
    return group_counts(df.where(F.col(column).isNotNull()), [column], most)


def commonalities(df: DataFrame, fields: list[str], numbers: list[str]) -> DataFrame:
    """What a selection shares: fields with just one nonblank value, and ranges of numbers."""
    same = [F.when(F.min(or_null(F.col(c))) == F.max(or_null(F.col(c))), F.min(or_null(F.col(c)))).alias(f"common_{c}") for c in fields]
    return df.agg(*same, *[f(c).alias(f"{n}_{c}") for c in numbers for n, f in (("min", F.min), ("max", F.max))])


def provider_stats(df: DataFrame, provider: str, status: str, statuses: list[str]) -> DataFrame:
    return df.groupBy(provider).agg(F.count("*").alias("results"), *[F.count_if(F.col(status) == s).alias(s) for s in statuses])


def normalization_incidents(df: DataFrame, row_id: str, columns: list[str]) -> DataFrame:
    """Every cell that display normalisation would change."""
    cells = df.select(row_id, *[text_of(F.col(c)).alias(c) for c in columns]).unpivot([row_id], columns, "field_name", "before")
    return cells.withColumn("after", display_text(F.col("before"))).where(F.col("before") != F.col("after"))


def listed_distinct(c: Column) -> Column:
    """Distinct values as one ordered text."""
    return F.array_join(F.sort_array(F.collect_set(c)), ",")
