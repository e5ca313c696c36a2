"""What the registered queries share: tables, and a catalog made from them.

`part` stands for a catalog (name: title, brand: artist, type: album, size: tempo), `lineitem` for evidence and
membership, `events` for a log of checks. `staged` is the catalog with known changes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.session import ship_code

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query, and the SQL that gives the same rows."""

    def register(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_code(spark)
            return f(spark, sf_dir)

        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_brand").alias("artist"), F.col("p_type").alias("album"), F.col("p_size").alias("bpm"), F.col("p_retailprice").cast("string").alias("price"))


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog without each 11th row, some artists blank, some albums and tempos changed."""
    c = F.col
    rows = catalog(spark, sf_dir).where(c("id") % 11 != 0)
    return rows.withColumns({"artist": F.when(c("id") % 5 == 0, "").otherwise(c("artist")), "album": F.when(c("id") % 7 == 0, F.concat(c("album"), F.lit(" Deluxe"))).otherwise(c("album")), "bpm": F.when(c("id") % 13 == 0, c("bpm") + 1).otherwise(c("bpm"))})


CATALOG = "catalog AS (SELECT p_partkey AS id, p_name AS title, p_brand AS artist, p_type AS album, p_size AS bpm FROM part)"
STAGED = """staged AS (SELECT id, title, CASE WHEN id % 5 = 0 THEN '' ELSE artist END AS artist, CASE WHEN id % 7 = 0 THEN album || ' Deluxe' ELSE album END AS album,
  CASE WHEN id % 13 = 0 THEN bpm + 1 ELSE bpm END AS bpm FROM catalog WHERE id % 11 <> 0)"""
BOTH = f"WITH {CATALOG}, {STAGED}"


def sql_match(c: str) -> str:
    """match_text of plain columns in SQL."""
    return rf"lower(trim(regexp_replace(regexp_replace(strip_accents({c}), '[^\p{{L}}\p{{N}}_\s.,-]', '', 'g'), '\s+', ' ', 'g')))"


def sql_key(c: str) -> str:
    """song_key of ASCII columns in SQL."""
    t = f"replace(lower({c}), '&', ' and ')"
    for pattern, new in ((r"\b(feat|featuring|ft)\.?\b.*$", ""), (r"\([^)]*\)|\[[^\]]*\]", " "), (r"\bthe\b", " "), ("[^a-z0-9]+", " ")):
        t = f"regexp_replace({t}, '{pattern}', '{new}', 'g')"
    return f"trim({t})"


def sql_compact(c: str) -> str:
    return f"regexp_replace(lower({c}), '[^a-z0-9]+', '', 'g')"
