"""Queries of file ingest, sinks, seeds and evidence, and of streams that resume."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import catalog as build
from ..operators import dedupe, evidence, matching, rows
from ..sources import publish, tables
from ..sources.session import new_path
from ..streaming import ledger
from . import change, match
from .base import BOTH, CATALOG, ORACLES, catalog, query, staged, table

FILE_ROWS = 10_000


# --- sources

@query("SELECT CAST(p_partkey AS VARCHAR) AS part_key, p_name AS part_name FROM part")
def header_load(spark: SparkSession, d: str) -> DataFrame:
    path = new_path(spark, "headers")
    tables.write_csv(table(spark, d, "part").select(F.col("p_partkey").alias("part key"), F.col("p_name").alias("part name")), path)
    return rows.clean_headers(tables.read_csv(spark, path))


@query("SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) + 1 AS row_number FROM part")
def row_numbers(spark: SparkSession, d: str) -> DataFrame:
    return tables.with_row_number(table(spark, d, "part").select("p_partkey"))


@query("SELECT p_size, count(*) AS n_rows, true AS hashes_hold FROM part GROUP BY 1")
def file_inventory(spark: SparkSession, d: str) -> DataFrame:
    """A folder of CSV files by size and of files of other kinds: what the CSV files hold."""
    path = new_path(spark, "folder")
    part = table(spark, d, "part").select("p_size", "p_partkey", "p_name")
    part.repartition("p_size").write.option("maxRecordsPerFile", FILE_ROWS).partitionBy("p_size").csv(f"{path}/lists")
    part.write.json(f"{path}/other")
    text = tables.decoded(F.col("content"))
    found = tables.files_under(spark, path, ("csv",)).select(F.regexp_extract("path", r"p_size=(\d+)", 1).cast("int").alias("p_size"), F.size(F.filter(F.split(text, "\n"), lambda x: x != "")).alias("n"), (F.col("sha256") == F.sha2("content", 256)).alias("ok"))
    return found.groupBy("p_size").agg(F.sum("n").alias("n_rows"), F.bool_and("ok").alias("hashes_hold"))


@query("SELECT p_name AS title, p_brand AS artist, p_type AS album, p_type AS raw_release FROM part")
def header_synonyms(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    listed = table(spark, d, "part").select(c("p_type").alias("Release"), c("p_brand").alias("ARTIST "), c("p_name").alias("Track Name"))
    return tables.as_observations(listed).select("title", "artist", "album", F.element_at("raw", "Release").alias("raw_release"))


@query("SELECT 'part' AS name, count(*) AS n_rows FROM part UNION ALL SELECT 'orders', count(*) FROM orders")
def tables_present(spark: SparkSession, d: str) -> DataFrame:
    """Row counts of those of three tables that the session knows."""
    for name in ("part", "orders"):
        table(spark, d, name).createOrReplaceTempView(f"staged_{name}")
    found = {n: t for n in ("part", "orders", "absent") if (t := tables.table_if_present(spark, f"staged_{n}")) is not None}
    counts = [t.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("name"), "n_rows") for n, t in found.items()]
    return counts[0].unionByName(counts[1])


@query(f"{change.PATCHES} SELECT patch_id, target_column, new_value FROM p")
def manifest_ingest(spark: SparkSession, d: str) -> DataFrame:
    path = new_path(spark, "manifest")
    tables.write_csv(change.patches(spark, d), path)
    required = ["patch_id", "seq", "match_column", "match_value", "target_column", "old_value", "new_value"]
    return tables.patch_manifest(tables.read_csv(spark, path), required).select("patch_id", "target_column", "new_value")


# --- sinks

@query("""SELECT p_partkey AS id, '"' || p_name || '" - ' || p_brand AS title FROM part""")
def display_rows(spark: SparkSession, d: str) -> DataFrame:
    """Typographic characters and extra spaces as a display file shows them."""
    path = new_path(spark, "display")
    odd = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.concat(F.lit("“"), "p_name", F.lit("”  — "), "p_brand").alias("title"))
    tables.write_csv(odd, path, display=True)
    return tables.read_csv(spark, path).select(F.col("id").cast("long").alias("id"), "title")


@query("SELECT p_brand, count(*) AS n FROM part GROUP BY 1")
def summary_sink(spark: SparkSession, d: str) -> DataFrame:
    path = new_path(spark, "summary")
    tables.write_summary(table(spark, d, "part").groupBy("p_brand").agg(F.count("*").alias("n")), path)
    return spark.read.schema("p_brand string, n long").json(path)


@query("SELECT p_partkey, p_name FROM part WHERE p_size > 10")
def replace_sink(spark: SparkSession, d: str) -> DataFrame:
    """A table that is loaded twice: the second load is all that stays."""
    path = new_path(spark, "replaced")
    part = table(spark, d, "part").select("p_partkey", "p_name", "p_size")
    first = publish.publish(part.drop("p_size"), path, None)
    publish.publish(part.where("p_size > 10").drop("p_size"), path, first)
    return publish.read_version(spark, path)


# --- filters, joins and groups

@query(f"{BOTH} SELECT id FROM staged WHERE bpm > 25 AND artist <> ''")
def approved_rows(spark: SparkSession, d: str) -> DataFrame:
    decision = F.when(F.col("bpm") > 25, " Approve ").otherwise("reject")
    return staged(spark, d).where(rows.approved(decision, [F.col(c) for c in ("title", "artist", "album")])).select("id")


@query(f"{BOTH} SELECT c.id FROM catalog c JOIN staged s ON c.id = s.id WHERE s.artist = '' OR s.album = c.album")
def compact_matches(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose wanted artist is blank or theirs; where the album changed, another artist is wanted."""
    c = F.col
    other = staged(spark, d).select("id", F.upper("title").alias("t"), F.when((c("artist") != "") & c("album").endswith("Deluxe"), c("album")).otherwise(c("artist")).alias("a"))
    return catalog(spark, d).join(other, "id").where(rows.compact_match(c("title"), c("artist"), c("t"), c("a"))).select("id")


@query(f"""{BOTH}, n AS (SELECT l_partkey, count(*) AS n_lines FROM lineitem GROUP BY 1), q AS (SELECT l_partkey, max(l_quantity) AS most FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
  SELECT c.id, c.title, s.album AS staged_album, n_lines, most FROM catalog c LEFT JOIN staged s ON s.id = c.id LEFT JOIN n ON n.l_partkey = c.id LEFT JOIN q ON q.l_partkey = c.id""")
def star_join(spark: SparkSession, d: str) -> DataFrame:
    """The catalog with three tables of one row an id beside it."""
    lines = table(spark, d, "lineitem")
    counts, most = lines.groupBy("l_partkey").agg(F.count("*").alias("n")), lines.where("l_returnflag = 'R'").groupBy("l_partkey").agg(F.max("l_quantity").alias("q"))
    lookups = [(staged(spark, d), {"id": "id"}, {"album": "staged_album"}), (counts, {"id": "l_partkey"}, {"n": "n_lines"}), (most, {"id": "l_partkey"}, {"q": "most"})]
    return build.with_context(catalog(spark, d).select("id", "title"), lookups)


@query(f"WITH {CATALOG} SELECT id, count(*) OVER (PARTITION BY title, artist) AS group_size FROM catalog")
def group_size(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.with_group_size(catalog(spark, d), ["title", "artist"]).select("id", "group_size")


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem WHERE l_partkey IN (l_orderkey, l_linenumber) OR l_suppkey IN (l_orderkey, l_linenumber)")
def shared_ids(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose two sets of ids are not disjoint."""
    c = F.col
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return lines.where(~rows.disjoint([c("l_partkey"), c("l_suppkey")], [c("l_orderkey"), c("l_linenumber")]))


# --- evidence

@query(f"{BOTH} SELECT 'SEED-' || upper(sha1(lower(title) || '|' || lower(replace(artist, '#', '')) || '|' || lower(album)))[:16] AS seed_id, min(id) AS id FROM staged WHERE artist <> '' GROUP BY 1")
def seeds(spark: SparkSession, d: str) -> DataFrame:
    return evidence.seed_entities(staged(spark, d), "title", "artist", "album", ["id"]).select("seed_id", "id")


@query(f"WITH {CATALOG} SELECT id, sha1('list.csv|' || id || '|' || title || '|' || artist || '|' || album) AS observation_id FROM catalog")
def observed_rows(spark: SparkSession, d: str) -> DataFrame:
    """The catalog read twice: each observation once."""
    twice = catalog(spark, d).unionByName(catalog(spark, d))
    return evidence.observations(twice, F.lit("list.csv"), F.col("id"), "title", "artist", "album").select("id", "observation_id")


@query("""SELECT id, source_name, field_value, sha1(id || '|' || field_name || '|' || field_value) AS identifier_id FROM (
  SELECT p_partkey AS id, 'Spotify' AS source_name, 'Spotify Track Id' AS field_name, 'S' || p_partkey AS field_value FROM part WHERE p_size % 4 <> 0
  UNION ALL SELECT p_partkey, 'ISRC', 'isrc', p_brand || p_size FROM part)""")
def identified_rows(spark: SparkSession, d: str) -> DataFrame:
    """Identifiers in the cells of each row; a quarter have a placeholder."""
    c = F.col
    track = F.when(c("p_size") % 4 == 0, " N/A ").otherwise(F.concat(F.lit("S"), "p_partkey"))
    raw = F.create_map(F.lit("Spotify Track Id"), track, F.lit("isrc"), F.concat("p_brand", "p_size"), F.lit("Note"), c("p_name"))
    return evidence.identifiers(table(spark, d, "part").select(c("p_partkey").alias("id"), raw.alias("raw")), "id", "raw").select("id", "source_name", "field_value", "identifier_id")


@query("""SELECT l_partkey, CASE WHEN r AND a THEN 'verified' WHEN r OR a THEN 'partially_verified' ELSE 'unverified' END AS status
  FROM (SELECT l_partkey, bool_or(l_returnflag = 'R' AND l_quantity > 25) AS r, bool_or(l_returnflag = 'A' AND l_quantity > 25) AS a FROM lineitem GROUP BY 1)""")
def two_sources(spark: SparkSession, d: str) -> DataFrame:
    said = lambda flag: F.when(F.bool_or((F.col("l_returnflag") == flag) & (F.col("l_quantity") > 25)), "Yes").otherwise("No")
    found = table(spark, d, "lineitem").groupBy("l_partkey").agg(said("R").alias("first"), said("A").alias("second"))
    return found.select("l_partkey", matching.two_source_status(F.col("first"), F.col("second")).alias("status"))


@query(f"WITH {match.ATTEMPTS} SELECT entity, provider, 'E' || attempt_id AS entity_id FROM (SELECT *, row_number() OVER (PARTITION BY entity, provider ORDER BY score DESC, attempt_id) AS n FROM attempts WHERE verdict <> 'rejected') WHERE n = 1")
def first_ids(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    found = match.attempts(spark, d).withColumn("entity_id", F.when(c("verdict") != "rejected", F.concat(F.lit("E"), c("attempt_id"))).otherwise(" "))
    return evidence.first_provider_ids(found, "entity", "entity_id", "attempt_id")


@query(f"SELECT entity, target_field, sha1(entity || '|catalog|entity|' || target_field || '|' || proposed_value) AS promotion_id FROM ({ORACLES['promotion_candidates']}) WHERE best_score >= 900")
def approved_promotions(spark: SparkSession, d: str) -> DataFrame:
    """Candidates with a high score as promotions."""
    approved = match.promotion_candidates(spark, d).where(rows.approved(F.when(F.col("best_score") >= 900, "approve").otherwise("reject"), [F.col("proposed_value")]))
    return evidence.promotions(approved, "entity", "catalog", ["supporting_sources", "best_score"]).select("entity", "target_field", "promotion_id")


# --- streams

def events_stream(spark: SparkSession, d: str) -> DataFrame:
    """The events as a stream of at least two batches."""
    source = new_path(spark, "events")
    events = table(spark, d, "events")
    events.repartition(4, "event_id").write.parquet(source)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(source)


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS user_id FROM events")
def stream_resume(spark: SparkSession, d: str) -> DataFrame:
    """A stream into a table that has a third of its keys: these rows stay as they are."""
    out, mark = new_path(spark, "resumed"), new_path(spark, "mark")
    table(spark, d, "events").where("event_id % 3 = 0").select("event_id", F.lit(-1).cast("long").alias("user_id")).write.parquet(out)
    ledger.resume_stream(events_stream(spark, d).select("event_id", "user_id"), out, mark, ["event_id"]).awaitTermination()
    return spark.read.parquet(out)


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_new_keys(spark: SparkSession, d: str) -> DataFrame:
    out, mark = new_path(spark, "keys"), new_path(spark, "mark")
    fresh = ledger.new_keys_stream(events_stream(spark, d).select("user_id", "event_type"), ["user_id", "event_type"])
    fresh.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("user_id long, event_type string").parquet(out)
