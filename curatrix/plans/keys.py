"""Queries of key variants, list cells, notes and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as x
from ..functions import values as v
from .base import BOTH, query, sql_compact, sql_key, staged, table
from .basic import TITLES, titled


def sql_spaced(c: str, *patterns: str) -> str:
    """A spaced key of ASCII columns in SQL, with the patterns dropped first."""
    t = f"replace(lower({c}), '&', ' and ')"
    for pattern in patterns:
        t = f"regexp_replace({t}, '{pattern}', ' ', 'g')"
    return f"trim(regexp_replace({t}, '[^a-z0-9]+', ' ', 'g'))"


@query(rf"""SELECT p_partkey AS id, {sql_key('t')} AS import_key, {sql_spaced('t', r'\bthe\b')} AS merge_key, {sql_spaced('t', r'\b(feat|featuring|ft)\.?\b.*$', r'\([^)]*\)|\[[^\]]*\]')} AS takeout_key,
  CASE WHEN starts_with({sql_compact('t')}, 'the') AND length({sql_compact('t')}) > 3 THEN substr({sql_compact('t')}, 4) ELSE {sql_compact('t')} END AS compact_artist FROM (SELECT p_partkey, {TITLES} AS t FROM part)""")
def key_variants(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("noisy")
    return titled(spark, d).select("id", x.import_key(t).alias("import_key"), x.merge_key(t).alias("merge_key"), x.takeout_key(t).alias("takeout_key"), x.compact_artist(t).alias("compact_artist"))


@query("SELECT p_partkey AS id, p_brand AS listed, p_brand AS bare FROM part")
def artist_cleaning(spark: SparkSession, d: str) -> DataFrame:
    """Artists as lists number them, and with their title joined on."""
    c, k = F.col, F.col("p_size") % 4
    numbered = F.concat(F.when(k == 0, "12. ").when(k == 1, "xiv. ").when(k == 2, "- ").otherwise("Songs Like "), c("p_brand"))
    return table(spark, d, "part").select(c("p_partkey").alias("id"), x.clean_list_artist(numbered).alias("listed"), x.artist_without_title(F.concat("p_brand", F.lit(" - "), F.upper("p_name")), c("p_name")).alias("bare"))


@query(rf"""SELECT p_partkey AS id, regexp_matches(t || ' ' || p_brand, '(?i)\bfeat\b|\bft\.|\bvs\.?\b|&|;|/|\bremix\b|\bcover\b|\blive\b') AS interesting, regexp_matches(lower(t), '\||cover|acoustic|feat\.|/|-') AS video
  FROM (SELECT p_partkey, p_brand, {TITLES} AS t FROM part)""")
def text_flags(spark: SparkSession, d: str) -> DataFrame:
    return titled(spark, d).select("id", x.looks_interesting(F.col("noisy"), F.col("artist")).alias("interesting"), x.looks_video_title(F.col("noisy")).alias("video"))


@query("""SELECT p_partkey AS id, replace(p_name, ' ', '; ') AS joined, replace(p_name, ' ', '; ') || '; ' || p_brand AS added,
  printf('%d:%02d', CAST(floor(p_retailprice / 60) AS BIGINT), CAST(floor(p_retailprice) AS BIGINT) % 60) AS duration, printf('%d.%03d', p_size * 137 // 1000, p_size * 137 % 1000) AS score FROM part""")
def cell_lists(spark: SparkSession, d: str) -> DataFrame:
    """List cells of each name's words, said twice; a duration rounded down; a score as text."""
    c = F.col
    words = F.concat_ws(";", F.replace("p_name", F.lit(" "), F.lit(";")), F.upper(F.replace("p_name", F.lit(" "), F.lit("; "))))
    once = F.replace("p_name", F.lit(" "), F.lit(" ; "))
    return table(spark, d, "part").select(
        c("p_partkey").alias("id"), v.semicolon_join(v.listed(words)).alias("joined"), v.added_to_list(once, F.concat_ws(";", "p_brand", once)).alias("added"),
        v.duration_from_ms(c("p_retailprice") * 1000 + 0.5, floor=True).alias("duration"), v.score_text(c("p_size") * 137).alias("score"),
    )


@query(f"""{BOTH} SELECT id, CASE WHEN artist = '' THEN 2 ELSE 3 END + CASE WHEN bpm > 25 THEN 2 ELSE 0 END AS points, 'title=' || title || CASE WHEN artist = '' THEN '' ELSE '; artist=' || artist END AS note,
  CASE WHEN lower(album) LIKE '%deluxe%' THEN 'edition' WHEN lower(album) LIKE '%eco%' THEN 'plain' ELSE 'unknown' END AS origin, '{{"artist":"' || artist || '","title":"' || title || '"}}' AS canonical FROM staged""")
def row_notes(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    points = v.completeness([c("title"), c("artist"), c("album")], [(c("bpm") > 25, 2)])
    pair = F.create_map(F.lit("title"), c("title"), F.lit("artist"), c("artist"))
    return staged(spark, d).select("id", points.alias("points"), v.filled_note({"title": c("title"), "artist": c("artist")}).alias("note"), v.provenance(c("album"), {"deluxe": "edition", "eco": "plain"}, "unknown").alias("origin"), v.canonical_json(pair).alias("canonical"))


@query(f"""SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year_found, {sql_key('o_orderpriority')} || '|||' || {sql_key('o_orderstatus')} || '|||k' || o_custkey || '|||' || CAST(o_orderkey % 60 AS VARCHAR) || ':07' AS signature FROM orders""")
def order_years(spark: SparkSession, d: str) -> DataFrame:
    """The year of each order's date, of the first of three columns that has one, and a signature of four fields."""
    c = F.col
    date = F.date_format("o_orderdate", "yyyy-MM-dd")
    odd = c("o_orderkey") % 2 == 1
    year = v.best_year(F.when(odd, date).otherwise("unknown"), F.when(odd, "1800").otherwise(date), F.lit("1700-01-01"))
    duration = F.concat(F.lit("0"), c("o_orderkey") % 60, F.lit(":07"))
    signature = v.song_signature(c("o_orderpriority"), c("o_orderstatus"), F.concat(F.lit("K"), "o_custkey"), duration)
    return table(spark, d, "orders").select("o_orderkey", year.alias("year_found"), signature.alias("signature"))
