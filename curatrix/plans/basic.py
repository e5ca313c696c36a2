"""Queries of normalisation, profiles, search and listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as x
from ..functions import values as v
from ..operators import dedupe, profile, rows, term_index
from ..sources import tables
from ..sources.session import new_path
from ..streaming import ledger
from .base import BOTH, CATALOG, catalog, query, sql_compact, sql_key, sql_match, staged, table


@query(f"WITH k AS (SELECT sha256({sql_match('p_name')} || '|' || {sql_match('p_brand')}) AS identity, p_partkey AS id FROM part) SELECT identity, count(*) OVER (PARTITION BY identity) AS group_size, id FROM k QUALIFY group_size > 1")
def duplicate_groups(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.duplicate_groups(catalog(spark, d), v.stable_id(F.col("title"), F.col("artist")), "id")


@query(f"SELECT sha256({sql_match('p_name')} || '|' || {sql_match('p_brand')} || '|' || {sql_match('p_type')}) AS identity, count(*) AS group_size FROM part GROUP BY 1 HAVING count(*) > 1")
def version_groups(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.group_sizes(catalog(spark, d), v.stable_id(F.col("title"), F.col("artist"), F.col("album")))


@query(f"SELECT doc_id, sha256({sql_match('text')}) AS match_sha256 FROM documents")
def normalize_documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.sha2(x.match_text(F.col("text")), 256).alias("match_sha256"))


@query(f"SELECT doc_id, sha256({sql_match('text')}) AS search_sha256 FROM documents WHERE lang <> 'en'")
def sql_udf(spark: SparkSession, d: str) -> DataFrame:
    x.register(spark)
    table(spark, d, "documents").createOrReplaceTempView("udf_documents")
    return spark.sql("SELECT doc_id, sha2(normalize_search_text(text), 256) AS search_sha256 FROM udf_documents WHERE lang <> :lang", args={"lang": "en"})


@query(r"SELECT doc_id, 'text' AS field_name, sha256(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS after_sha256 FROM documents WHERE trim(regexp_replace(text, '\s+', ' ', 'g')) <> text")
def normalization_incidents(spark: SparkSession, d: str) -> DataFrame:
    found = profile.normalization_incidents(table(spark, d, "documents"), "doc_id", ["text"])
    return found.select("doc_id", "field_name", F.sha2("after", 256).alias("after_sha256"))


TITLES = "CASE p_partkey % 4 WHEN 0 THEN p_name || ' (Official Video)' WHEN 1 THEN p_name || ' feat. ' || p_brand WHEN 2 THEN 'The ' || p_name || ' [Live] & more' ELSE p_brand || ' - ' || p_name END"


def titled(spark: SparkSession, d: str) -> DataFrame:
    """The catalog with titles as video sites write them."""
    c, k = F.col, F.col("id") % 4
    noisy = F.when(k == 0, F.concat("title", F.lit(" (Official Video)"))).when(k == 1, F.concat("title", F.lit(" feat. "), "artist")).when(k == 2, F.concat(F.lit("The "), "title", F.lit(" [Live] & more"))).otherwise(F.concat("artist", F.lit(" - "), "title"))
    return catalog(spark, d).withColumn("noisy", noisy).select("id", "title", "artist", c("noisy"))


@query(rf"""SELECT p_partkey AS id, {sql_key('t')} AS song_key, {sql_compact('t')} AS compact_key,
  trim(regexp_replace(regexp_replace(t, '(?i)\s*\(([^)]*(?:official|video|lyric|channel|topic|hd|4k|audio|preview)[^)]*)\)', '', 'g'), '\s+', ' ', 'g')) AS clean_title,
  regexp_split_to_array(t, '(?i)\s+(?:feat\.?|ft\.?|featuring)\s+')[1] AS lead,
  trim(regexp_replace(regexp_replace(regexp_replace(lower(t), '\s*\[[^\]]*live[^\]]*\]', ' ', 'g'), '&', ' and ', 'g'), '[^a-z0-9]+', ' ', 'g')) AS title_core
  FROM (SELECT p_partkey, {TITLES} AS t FROM part)""")
def match_keys(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("noisy")
    return titled(spark, d).select("id", x.song_key(t).alias("song_key"), x.compact_key(t).alias("compact_key"), x.clean_title(t).alias("clean_title"), x.lead_artist(t).alias("lead"), x.title_core(t).alias("title_core"))


@query(rf"SELECT p_partkey AS id, t AS noisy FROM (SELECT p_partkey, {TITLES} AS t FROM part) WHERE p_partkey % 4 <> 2 OR lower(t) ~ '.*(hd|4k|audio|topic|channel).*'")
def suspicious_rows(spark: SparkSession, d: str) -> DataFrame:
    return titled(spark, d).where(x.looks_suspicious(F.col("noisy"), F.col("artist"))).select("id", "noisy")


@query("SELECT CAST(floor(year(o_orderdate) / 10) * 10 AS INTEGER) AS decade, count(*) AS n FROM orders GROUP BY 1")
def decade_histogram(spark: SparkSession, d: str) -> DataFrame:
    return profile.bucket_counts(table(spark, d, "orders"), profile.decade(F.year("o_orderdate").cast("string")), "decade")


@query("SELECT token, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS token FROM part) WHERE token <> 'ring' GROUP BY 1 ORDER BY n DESC, token LIMIT 10")
def token_topk(spark: SparkSession, d: str) -> DataFrame:
    return profile.token_counts(table(spark, d, "part"), v.listed(F.col("p_name"), " "), ["ring"], 10)


@query("""SELECT grp, token, n, CAST(place AS INTEGER) AS place FROM (SELECT grp, token, n, row_number() OVER (PARTITION BY grp ORDER BY n DESC, token) AS place FROM (
  SELECT CAST(floor(p_size / 10) * 10 AS BIGINT) AS grp, token, count(*) AS n FROM (SELECT p_size, unnest(string_split(p_name, ' ')) AS token FROM part) GROUP BY 1, 2)) WHERE place <= 5""")
def group_token_top5(spark: SparkSession, d: str) -> DataFrame:
    return profile.token_counts(table(spark, d, "part"), v.listed(F.col("p_name"), " "), [], 5, by=(F.floor(F.col("p_size") / 10) * 10).cast("long"))


@query(f"{BOTH} SELECT id, title, artist FROM catalog WHERE contains(lower(title), 'red') AND (contains(lower(title), 'ring') OR contains(lower(artist), 'ring') OR contains(lower(album), 'ring'))")
def vibe_search(spark: SparkSession, d: str) -> DataFrame:
    return rows.vibe_search(catalog(spark, d), "Red  RING", ["title", "artist", "album"]).select("id", "title", "artist")


@query(f"{BOTH} SELECT id, title, artist FROM catalog WHERE contains(lower(title), 'red') AND (contains(lower(title), 'ring') OR contains(lower(artist), 'ring') OR contains(lower(album), 'ring'))")
def indexed_search(spark: SparkSession, d: str) -> DataFrame:
    """The same by an index of the catalog."""
    path, columns = new_path(spark, "index"), ["title", "artist", "album"]
    term_index.build(catalog(spark, d), path, "id", columns)
    return term_index.search(spark, path, "Red  RING", "id", columns).select("id", "title", "artist")


@query("SELECT p_partkey, p_name, p_size FROM part WHERE regexp_matches(p_name, '(?i)^(red|small)') AND p_type IN ('ECONOMY', 'STANDARD') AND p_size BETWEEN 10 AND 20")
def grid_filter(spark: SparkSession, d: str) -> DataFrame:
    return rows.grid_filter(table(spark, d, "part"), "^(red|small)", ["p_name"], {"p_type": ["ECONOMY", "STANDARD"]}, {"p_size": (10, 20)}).select("p_partkey", "p_name", "p_size")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 25")
def paged_list(spark: SparkSession, d: str) -> DataFrame:
    return rows.page(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 50, 25)


@query(f"{BOTH} SELECT count(*) AS n_rows, count(*) FILTER (artist = '') AS no_artist, count(*) FILTER (artist = '' AND bpm > 25) AS no_artist_fast, count(*) FILTER (album LIKE '%Deluxe') AS deluxe FROM staged")
def quality_report(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    return profile.missing_report(staged(spark, d), {"no_artist": rows.lacks_all(c("artist")), "no_artist_fast": rows.lacks_any(c("artist"), c("title")) & (c("bpm") > 25), "deluxe": c("album").endswith("Deluxe")})


@query(f"{BOTH} SELECT count(*) FILTER (title = '') AS blank_title, count(*) FILTER (artist = '') AS blank_artist, count(*) FILTER (album = '') AS blank_album FROM staged")
def blank_profile(spark: SparkSession, d: str) -> DataFrame:
    return profile.blank_profile(staged(spark, d), ["title", "artist", "album"])


@query(f"{BOTH} SELECT id, concat_ws('; ', CASE WHEN artist = '' THEN 'Missing required field: artist' END, CASE WHEN bpm NOT BETWEEN 1 AND 40 THEN 'bpm must be between 1 and 40' END) AS errors FROM staged WHERE artist = '' OR bpm NOT BETWEEN 1 AND 40")
def validate_rows(spark: SparkSession, d: str) -> DataFrame:
    checked = staged(spark, d).withColumn("e", v.validation_errors({"title": F.col("title"), "artist": F.col("artist")}, {"bpm": (F.col("bpm").cast("string"), 1, 40)}))
    return checked.where(F.size("e") > 0).select("id", F.array_join("e", "; ").alias("errors"))


@query("""SELECT count(*) AS n_rows, count(*) FILTER ((p_partkey % 2 = 0) AND (p_partkey % 3 = 0)) AS dual_verified, count(*) FILTER (NOT ((p_partkey % 2 = 0) AND (p_partkey % 3 = 0))) AS under_verified,
  count(*) FILTER (p_partkey % 2 = 0) AS verified_first, count(*) FILTER (p_partkey % 3 = 0) AS verified_second, count(*) FILTER (p_partkey % 5 = 0) AS with_code FROM part""")
def coverage(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    flag = lambda n: F.when(k % n == 0, "Yes").otherwise("No")
    return profile.verified_coverage(table(spark, d, "part"), {"first": flag(2), "second": flag(3)}, {"code": F.when(k % 5 == 0, F.col("p_name"))})


@query("""SELECT 'customer' AS table_name, count(*) AS n_rows FROM customer UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'part', count(*) FROM part""")
def table_counts(spark: SparkSession, d: str) -> DataFrame:
    return profile.table_counts({t: table(spark, d, t) for t in ("customer", "lineitem", "orders", "part")})


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def two_key_counts(spark: SparkSession, d: str) -> DataFrame:
    return profile.group_counts(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"])


@query("SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY 1 ORDER BY n DESC, l_suppkey LIMIT 25")
def topk_values(spark: SparkSession, d: str) -> DataFrame:
    return profile.value_counts(table(spark, d, "lineitem"), "l_suppkey", 25)


@query("""SELECT l_shipmode AS provider, count(*) AS results, count(*) FILTER (s = 'matched') AS matched, count(*) FILTER (s = 'needs_review') AS needs_review, count(*) FILTER (s = 'rejected') AS rejected
  FROM (SELECT 'P' || (l_suppkey % 3) AS l_shipmode, CASE l_returnflag WHEN 'A' THEN 'matched' WHEN 'R' THEN 'rejected' ELSE 'needs_review' END AS s FROM lineitem) GROUP BY 1""")
def provider_stats(spark: SparkSession, d: str) -> DataFrame:
    f = F.col("l_returnflag")
    status = F.when(f == "A", "matched").when(f == "R", "rejected").otherwise("needs_review")
    named = table(spark, d, "lineitem").select(F.concat(F.lit("P"), F.col("l_suppkey") % 3).alias("provider"), status.alias("s"))
    return profile.provider_stats(named, "provider", "s", ["matched", "needs_review", "rejected"])


@query(f"WITH {CATALOG} SELECT CASE WHEN count(DISTINCT artist) = 1 THEN min(artist) END AS common_artist, CASE WHEN count(DISTINCT album) = 1 THEN min(album) END AS common_album, min(bpm) AS min_bpm, max(bpm) AS max_bpm FROM catalog WHERE artist = 'Brand#2'")
def commonalities(spark: SparkSession, d: str) -> DataFrame:
    return profile.commonalities(catalog(spark, d).where("artist = 'Brand#2'"), ["artist", "album"], ["bpm"])


@query("SELECT user_id, count(*) AS n, min(ts) AS first_seen, max(ts) AS last_seen, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS kinds FROM events GROUP BY 1")
def first_last_seen(spark: SparkSession, d: str) -> DataFrame:
    found = profile.seen_rollup(table(spark, d, "events"), "user_id", "ts", {"kinds": "event_type"})
    return found.withColumn("kinds", F.array_join("kinds", ","))


LEDGER_SQL = """SELECT user_id, event_type, count(*) AS query_count, max(ts) AS last_checked, arg_max(event_id, (ts, event_id)) AS last_sequence, arg_max(value, (ts, event_id)) AS last_value FROM events GROUP BY 1, 2"""


@query(LEDGER_SQL)
def check_ledger(spark: SparkSession, d: str) -> DataFrame:
    return ledger.rolled_up(table(spark, d, "events"), ["user_id", "event_type"], "ts", ["value"], "event_id")


@query(LEDGER_SQL)
def stream_ledger(spark: SparkSession, d: str) -> DataFrame:
    """The same by a stream that is run to its end, in two batches at least."""
    source, out, mark = (new_path(spark, n) for n in ("events", "ledger", "mark"))
    events = table(spark, d, "events")
    events.repartition(4, "event_id").write.parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(source)
    ledger.ledger_stream(spark, stream, out, mark, ["user_id", "event_type"], "ts", ["value"], "event_id").awaitTermination()
    return ledger.latest_ledger(spark, out, ["user_id", "event_type"])


@query("SELECT user_id, count(*) AS n, min(ts) AS first_seen, max(ts) AS last_seen FROM events GROUP BY 1")
def stream_seen(spark: SparkSession, d: str) -> DataFrame:
    source, mark = new_path(spark, "events"), new_path(spark, "mark")
    events = table(spark, d, "events")
    events.repartition(4, "event_id").write.parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(source)
    name = f"seen_{mark[-32:]}"
    out = new_path(spark, "seen")
    seen = ledger.seen_stream(stream, "user_id", "ts")
    keep = lambda batch, _: batch.write.mode("overwrite").parquet(out)  # noqa: E731  in complete mode the last batch is the whole result
    seen.writeStream.outputMode("complete").queryName(name).foreachBatch(keep).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


@query("SELECT user_id, arg_max(ts, (ts, event_id)) FILTER (event_type = 'click') AS click, arg_max(ts, (ts, event_id)) FILTER (event_type = 'error') AS error, arg_max(ts, (ts, event_id)) FILTER (event_type = 'view') AS view FROM events GROUP BY 1")
def latest_pivot(spark: SparkSession, d: str) -> DataFrame:
    return ledger.latest_checks(table(spark, d, "events"), "user_id", "event_type", ["click", "error", "view"], "ts", "event_id")


@query(f"{BOTH} SELECT id, 'title' AS field_name, title AS field_value FROM staged UNION ALL SELECT id, 'artist', artist FROM staged WHERE artist <> '' UNION ALL SELECT id, 'bpm', CAST(bpm AS VARCHAR) FROM staged")
def eav_unpivot(spark: SparkSession, d: str) -> DataFrame:
    return rows.to_observations(staged(spark, d), ["id"], ["title", "artist", "bpm"])


@query(f"WITH {CATALOG} SELECT id, site, url FROM (SELECT id, unnest(['a', 'b', 'c']) AS site, unnest(['https://a.example/?q=', 'https://b.example/?q=', 'https://c.example/?q=']) || replace(title, ' ', '+') AS url FROM catalog)")
def link_rows(spark: SparkSession, d: str) -> DataFrame:
    links = [F.struct(F.lit(s).alias("site"), v.search_url(f"https://{s}.example/?q=", F.col("title")).alias("url")) for s in "abc"]
    return rows.exploded_structs(catalog(spark, d), ["id"], links)


@query("SELECT event_id, coalesce(json_extract_string(props, '$.k'), '') AS k, coalesce(json_extract_string(props, '$.missing'), '') AS missing FROM events")
def json_props(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", v.json_value(F.col("props"), "k").alias("k"), v.json_value(F.col("props"), "missing").alias("missing"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) > 50")
def payload_rows(spark: SparkSession, d: str) -> DataFrame:
    return rows.payload_rows(table(spark, d, "events"), "props", "k int", {"k": F.col("p.k")}).where("k > 50").select("event_id", "k")


@query("SELECT * FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)")
def id_list(spark: SparkSession, d: str) -> DataFrame:
    return rows.with_ids(table(spark, d, "part"), table(spark, d, "lineitem").where("l_quantity > 49").select("l_partkey"), "p_partkey")


@query(f"{BOTH} SELECT id, title FROM staged WHERE artist <> '' AND id % 2 <> 0")
def unverified_rows(spark: SparkSession, d: str) -> DataFrame:
    flag = F.when(F.col("id") % 2 == 0, "Yes").otherwise("")
    return staged(spark, d).where(rows.unverified(F.col("title"), F.col("artist"), [flag])).select("id", "title")


@query(f"{BOTH} SELECT id, CASE WHEN artist <> '' THEN artist ELSE title END AS name, 'blank' AS note FROM staged")
def first_nonblank(spark: SparkSession, d: str) -> DataFrame:
    wide = rows.widened(rows.renamed(staged(spark, d), {"id": "id", "artist": "a", "title": "t"}), ["extra"])
    return wide.select("id", x.first_nonblank(F.col("extra"), F.col("a"), F.col("t")).alias("name"), F.when(x.is_blank(F.col("extra")), "blank").otherwise("").alias("note"))


@query("SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) WHERE n = 1")
def first_per_key(spark: SparkSession, d: str) -> DataFrame:
    return rows.first_per_key(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_orderdate")


@query("SELECT DISTINCT p_partkey, unnest(string_split(p_name, ' ')) AS tag FROM part")
def bridge(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.bridge(table(spark, d, "part"), "p_partkey", v.listed(F.col("p_name"), " "), "tag")


@query("SELECT p_partkey, p_name FROM part WHERE p_partkey >= 100 AND p_partkey < 150")
def row_slice(spark: SparkSession, d: str) -> DataFrame:
    return rows.row_slice(table(spark, d, "part"), "p_partkey", 100, limit=50).select("p_partkey", "p_name")


@query(f"{BOTH} SELECT id FROM catalog EXCEPT SELECT id FROM staged")
def keys_only_in_one(spark: SparkSession, d: str) -> DataFrame:
    return rows.keys_only_in(catalog(spark, d), staged(spark, d), ["id"])


@query(f"{BOTH} SELECT id, artist FROM catalog INTERSECT SELECT id, artist FROM staged")
def keys_in_both(spark: SparkSession, d: str) -> DataFrame:
    return rows.keys_in_both(catalog(spark, d), staged(spark, d), ["id", "artist"])


@query(f"{BOTH} SELECT id, album, 'a' AS side FROM catalog UNION ALL SELECT id, album, 'b' FROM staged")
def union_open(spark: SparkSession, d: str) -> DataFrame:
    return rows.union_open(catalog(spark, d).select("id", "album", F.lit("a").alias("side")), staged(spark, d).select("album", "id", F.lit("b").alias("side")))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity * 60 + l_linenumber AS BIGINT) AS seconds, CAST(floor(l_quantity) AS BIGINT) || ':' || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS compact,
  CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS number, CAST(year(l_shipdate) AS INTEGER) AS year_found, CAST(l_linenumber AS VARCHAR) || ':' || lpad(CAST(l_partkey % 60 AS VARCHAR), 2, '0') AS from_ms FROM lineitem""")
def value_parsers(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    lines = table(spark, d, "lineitem").withColumn("clock", v.clock(c("l_quantity").cast("int"), c("l_linenumber")))

    def parsed(df: DataFrame, key) -> DataFrame:
        compact = F.when(c("clock").isNotNull(), v.compact_duration(F.concat(F.lit("0"), c("clock")), key))
        return df.select("l_orderkey", "l_linenumber", "l_partkey", v.duration_seconds(c("clock")).alias("seconds"), compact.alias("compact"), v.numeric_string(c("l_quantity").cast("string")).alias("number"), v.year_in(F.date_format("l_shipdate", "dd.MM.yyyy")).alias("year_found"), v.duration_from_ms((c("l_linenumber") * 60 + c("l_partkey") % 60) * 1000).alias("from_ms"))

    return rows.apart(lines, x.has_non_ascii(c("clock")), lambda df: parsed(df, x.song_key), lambda df: parsed(df, x.ascii_song_key))


@query("SELECT doc_id, sha256(text) AS repaired_sha256 FROM documents")
def latin1_repair(spark: SparkSession, d: str) -> DataFrame:
    """Texts that were written as UTF-8 and read as Latin-1, repaired; those of ASCII alone stay as they are."""
    broken = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return table(spark, d, "documents").select("doc_id", F.sha2(x.repaired(broken), 256).alias("repaired_sha256"))


@query("SELECT p_partkey AS id, p_name AS name, p_size AS size, p_retailprice AS price FROM part")
def csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = new_path(spark, "parts")
    tables.write_csv(table(spark, d, "part"), path, ["p_partkey", "p_name", "p_size", "p_retailprice"])
    back = tables.read_csv(spark, path)
    return tables.typed(back, {"p_partkey": ("id", "integer"), "p_name": ("name", "string"), "p_size": ("size", "integer"), "p_retailprice": ("price", "real")}).withColumn("id", F.col("id").cast("long"))


@query("SELECT title, artist FROM (SELECT p_name AS title, p_brand AS artist FROM part)")
def list_ingest(spark: SparkSession, d: str) -> DataFrame:
    path = new_path(spark, "list")
    lines = table(spark, d, "part").select(F.concat("p_brand", F.lit(" — "), "p_name").alias("value"))
    lines.union(spark.createDataFrame([("# comment",), ("",), ("* note",)], "value string")).write.text(path)
    return tables.text_list(spark.read.text(path)).select("title", "artist")


@query("SELECT count(*) AS n_rows FROM part")
def append_sink(spark: SparkSession, d: str) -> DataFrame:
    """The catalog appended twice: the second time nothing is new."""
    path = new_path(spark, "appended")
    for _ in range(2):
        tables.append_new(table(spark, d, "part"), path, ["p_partkey"])
    return spark.read.parquet(path).agg(F.count("*").alias("n_rows"))


@query("SELECT p_partkey AS id, p_name AS title, trim(p_brand || ' ' || p_type) AS notes FROM part")
def flat_export(spark: SparkSession, d: str) -> DataFrame:
    return tables.flat_export(table(spark, d, "part"), {"p_partkey": "id", "p_name": "title"}, ["p_brand", "p_type"])


@query("SELECT count(*) AS n_rows, true AS same_after_shuffle FROM part")
def table_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    other = tables.fingerprint(part.repartition(5, "p_brand")).toDF("n", "x", "s")
    return tables.fingerprint(part).crossJoin(other).select("n_rows", ((F.col("hash_xor") == F.col("x")) & (F.col("hash_sum") == F.col("s"))).alias("same_after_shuffle"))


