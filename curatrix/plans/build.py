"""Queries of catalog building, candidates, covers, repairs and guarded writes."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values as v
from ..operators import catalog as build
from ..sources import publish, tables
from ..sources.session import new_path
from .base import BOTH, CATALOG, catalog, query, staged, table

SONG = "'S' || upper(sha1(lower(title) || '␟' || lower(replace(artist, '#', ''))))[:12]"


@query(f"WITH {CATALOG} SELECT {SONG} AS song_id, min(id) AS primary_recording_id, count(*) AS n_recordings FROM catalog GROUP BY 1")
def catalog_build(spark: SparkSession, d: str) -> DataFrame:
    recordings, songs = build.songs(catalog(spark, d), F.col("title"), F.col("artist"), "id")
    sizes = recordings.groupBy(F.col("song_id").alias("_s")).agg(F.count("*").alias("n_recordings"))
    return songs.join(sizes, F.col("song_id") == F.col("_s")).select("song_id", "primary_recording_id", "n_recordings")


@query(f"{BOTH}, r AS (SELECT c.id, c.title, s.album, {SONG.replace('title', 'c.title').replace('artist', 'c.artist')} AS song_id FROM catalog c LEFT JOIN staged s ON s.id = c.id AND c.id % 2 = 0), f AS (SELECT song_id, arg_min(title, id) AS t FROM r GROUP BY 1) SELECT id, coalesce(album, t) AS label FROM r JOIN f USING (song_id)")
def song_defaults(spark: SparkSession, d: str) -> DataFrame:
    known = staged(spark, d).where("id % 2 = 0").select("id", F.col("album").alias("label"))
    recordings, songs = build.songs(catalog(spark, d).join(known, "id", "left"), F.col("title"), F.col("artist"), "id")
    return build.with_song_defaults(recordings, songs, {"label": "title"}).select("id", "label")


DASHED = [
    ("current_cleaned", "t", "artist"), ("raw_title_cleaned_artist", "t", "artist"), ("cleaned_title_raw_artist", "t", "artist"),
    *[(f"split: - :left=artist{n}", "artist", "title") for n in ("", "_artist_raw", "_title_raw")], *[(f"split: - :left=title{n}", "title", "artist") for n in ("", "_artist_raw", "_title_raw")],
]


@query(f"""WITH {CATALOG}, n AS (SELECT *, artist || ' - ' || title AS t FROM catalog)
  {" UNION ALL ".join(f"SELECT id, CAST({i} AS INTEGER) AS position, '{n}' AS note, {t} AS cand_title, {a} AS cand_artist FROM n" for i, (n, t, a) in enumerate(DASHED))}""")
def title_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Every reading of each dashed title in its place: the row as it is, then the title split both ways."""
    dashed = catalog(spark, d).select("id", F.concat_ws(" - ", "artist", "title").alias("noisy"), "artist")
    return build.title_candidates(dashed, "noisy", "artist").select("id", "position", "note", "cand_title", "cand_artist")


@query(f"WITH {CATALOG} SELECT id, title AS cand_title, artist AS cand_artist FROM catalog")
def split_titles(spark: SparkSession, d: str) -> DataFrame:
    """The reading of each dashed title whose right part is the title."""
    dashed = catalog(spark, d).select("id", F.concat_ws(" - ", "artist", "title").alias("noisy"), F.lit("Various").alias("artist"))
    return build.title_candidates(dashed, "noisy", "artist").where("note = 'split: - :left=title'").select("id", "cand_title", "cand_artist")


READ = [
    ("current_cleaned", "c", "'Various'"), ("raw_title_cleaned_artist", "t", "'Various'"), ("cleaned_title_raw_artist", "c", "'Various'"),
    ("split: - :left=artist", "artist", "title || ' x'"), ("split: - :left=artist_artist_raw", "artist", "title || tail"), ("split: - :left=artist_title_raw", "artist", "title || ' x'"),
    ("split: - :left=title", "title || ' x'", "artist"), ("split: - :left=title_artist_raw", "title || ' x'", "artist"), ("split: - :left=title_title_raw", "title || tail", "artist"),
    ("title_noise_stripped", "c", "'Various'"),
]


@query(f"""WITH {CATALOG}, n AS (SELECT *, artist || ' - ' || title || ' x' AS c, CASE WHEN id % 3 = 1 THEN ' x (Official Video)' ELSE ' x' END AS tail FROM catalog), m AS (SELECT *, artist || ' - ' || title || tail AS t FROM n)
  SELECT id, note, cand_title, cand_artist FROM ({" UNION ALL ".join(f"SELECT id, '{n}' AS note, {t} AS cand_title, {a} AS cand_artist FROM m{' WHERE id % 3 = 1' if n == 'title_noise_stripped' else ''}" for n, t, a in READ)})""")
def title_readings(spark: SparkSession, d: str) -> DataFrame:
    """Every reading of dashed titles, a third of them with a video's noise."""
    c = F.col
    noisy = catalog(spark, d).select("id", F.concat(F.concat_ws(" - ", "artist", "title"), F.when(c("id") % 3 == 1, " x (Official Video)").otherwise(" x")).alias("noisy"), F.lit("Various").alias("artist"))
    return build.title_candidates(noisy, "noisy", "artist").select("id", "note", "cand_title", "cand_artist")


@query(f"WITH {CATALOG} SELECT id, CASE WHEN id % 3 <> 1 THEN 'skip_not_suspicious' WHEN bpm <= 10 THEN 'skip_no_result' ELSE 'replace' END AS action FROM catalog")
def cleanup_actions(spark: SparkSession, d: str) -> DataFrame:
    """A third of the titles have a video's noise; results are staged for those of songs above a tempo, under a key of their own."""
    c = F.col
    noisy = catalog(spark, d).select("id", "bpm", F.when(c("id") % 3 == 1, F.concat("title", F.lit(" x"), "id", F.lit(" (Official Video)"))).otherwise(c("title")).alias("noisy"), "artist")
    found = catalog(spark, d).where("bpm > 10 AND id % 3 = 1").select(F.lower(F.concat("title", F.lit(" x"), "id")).alias("key"), F.concat("title", F.lit(" x"), "id").alias("result_title"), c("artist").alias("result_artist"))
    return build.cleanup_actions(noisy, "id", "noisy", "artist", found, "key").select("id", "action")


LINES = "l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_name, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey)"


@query(f"WITH {LINES} SELECT l_orderkey, 'order ' || l_orderkey AS original_title, 'customer' AS original_artist, p_name AS cover_title, p_brand AS cover_artist, 'u' || l_linenumber AS url FROM l WHERE l_linenumber > 1 UNION ALL SELECT l_orderkey, p_name, p_brand, 'order ' || l_orderkey, 'customer', 'u' || l_linenumber FROM l WHERE l_linenumber = 1")
def cover_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Each order as a payload: its first lines are originals, the others covers."""
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    person = F.struct(F.col("p_name").alias("title"), F.col("p_brand").alias("artist"), F.concat(F.lit("u"), "l_linenumber").alias("url"))
    side = lambda first: F.collect_list(F.when((F.col("l_linenumber") == 1) == F.lit(first), person))
    payloads = lines.groupBy("l_orderkey").agg(F.to_json(F.struct(side(False).alias("covers"), side(True).alias("originals"))).alias("payload"))
    payloads = payloads.withColumns({"t": F.concat(F.lit("order "), "l_orderkey"), "a": F.lit("customer")})
    return build.relation_pairs(payloads, "l_orderkey", "t", "a", "payload")


@query(f"WITH {LINES}, o AS (SELECT l_orderkey, min(p_brand) AS original_artist FROM l WHERE l_linenumber = 1 GROUP BY 1) SELECT l.l_orderkey, l_partkey, p_brand, original_artist FROM l JOIN o ON l.l_orderkey = o.l_orderkey WHERE lower(p_brand) <> lower(original_artist)")
def work_covers(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_partkey", "p_brand", "l_linenumber")
    return build.work_covers(lines, "l_orderkey", "p_brand", F.col("l_linenumber") == 1).drop("l_linenumber")


@query("SELECT l_orderkey, l_linenumber FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END, l_linenumber, l_partkey, l_suppkey, l_quantity) AS n FROM lineitem WHERE l_quantity > 10) WHERE n = 1")
def original_choice(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").withColumn("place", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity"))
    return build.original_choice(lines, "l_orderkey", F.col("l_quantity") > 10, F.col("l_returnflag") == "R", "place").select("l_orderkey", "l_linenumber")


@query("""WITH k AS (SELECT user_id, arg_max(ts, (ts, event_id)) FILTER (event_type = 'click') AS checked_click, arg_max(ts, (ts, event_id)) FILTER (event_type = 'view') AS checked_view FROM events GROUP BY 1)
  SELECT e.event_id, e.user_id, checked_click, checked_view FROM events e LEFT JOIN k ON e.user_id = k.user_id WHERE e.event_type = 'purchase' AND e.user_id IN (SELECT user_id FROM events WHERE event_type = 'signup')""")
def cover_run(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    candidates = events.where("event_type = 'purchase'").select("event_id", "user_id")
    return build.cover_run(events.where("event_type = 'signup'"), "user_id", candidates, events, ["click", "view"], "event_type", "ts", "event_id")


@query("SELECT id, category, tag FROM (SELECT p_partkey AS id, 'colour' AS category, unnest(list_filter(string_split(p_name, ' '), lambda t: t IN ('red', 'blue', 'green'))[:1]) AS tag FROM part UNION ALL SELECT p_partkey, 'thing', unnest(list_filter(string_split(p_name, ' '), lambda t: t IN ('ring', 'widget'))[:2]) FROM part)")
def suggestion_rows(spark: SparkSession, d: str) -> DataFrame:
    return build.suggestions(table(spark, d, "part").withColumnRenamed("p_partkey", "id"), "id", v.listed(F.col("p_name"), " "), {"colour": (["red", "blue", "green"], 1), "thing": (["ring", "widget"], 2)})


@query("SELECT p_partkey AS id, array_to_string(list_filter(string_split(p_name, ' '), lambda t: t IN ('red', 'blue', 'green'))[:1], ', ') AS suggested_colour, array_to_string(list_filter(string_split(p_name, ' '), lambda t: t IN ('ring', 'widget'))[:2], ', ') AS suggested_thing, 'https://tags.example/' || p_partkey AS source_url, 'Medium' AS confidence FROM part")
def mood_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").withColumnRenamed("p_partkey", "id")
    return build.mood_suggestions(rows, "id", v.listed(F.col("p_name"), " "), F.concat(F.lit("https://tags.example/"), "id"), {"colour": (["red", "blue", "green"], 1), "thing": (["ring", "widget"], 2)}).drop("notes")


@query("SELECT p_partkey AS id, CAST(p_size AS VARCHAR) AS bpm, '' AS musical_key, 'Standard' AS tuning, 'None' AS capo, 'Intermediate' AS guitar_difficulty, 'Novice' AS bass_difficulty, 'Novice' AS drum_difficulty, '' AS vocal_range, 'Vocals, Guitar, Bass, Drums' AS instrumentation, 'Standard rock/pop arrangement' AS arrangement_notes, 'Generative Suggestion' AS source_url, 'Low' AS confidence, 'Auto-filled standard defaults; requires manual tuning verification.' AS notes FROM part")
def performance_rows(spark: SparkSession, d: str) -> DataFrame:
    return build.performance_suggestions(table(spark, d, "part").withColumnRenamed("p_partkey", "id"), "id", F.col("p_size"), F.lit(None))


ASKED = "replace(url_encode(p_brand || ' ' || p_name), '%20', '+')"


@query(f"SELECT p_partkey AS id, 'Ultimate Guitar' AS site, 'https://www.ultimate-guitar.com/search.php?search_type=title&value=' || {ASKED} AS search_url, 'Search Query' AS match_type FROM part UNION ALL SELECT p_partkey, 'SecondHandSongs', 'https://secondhandsongs.com/search?search_text=' || {ASKED}, 'Search Query' FROM part UNION ALL SELECT p_partkey, 'WhoSampled', 'https://www.whosampled.com/search/?q=' || {ASKED}, 'Search Query' FROM part")
def search_rows(spark: SparkSession, d: str) -> DataFrame:
    """Three searches of each record."""
    return build.search_suggestions(table(spark, d, "part").withColumnRenamed("p_partkey", "id"), "id", F.col("p_name"), F.col("p_brand")).select("id", "site", "search_url", "match_type")


@query("SELECT user_id, count(*) AS n, CASE WHEN user_id % 3 = 0 THEN 'not_found' ELSE 'found' END AS lookup_status FROM events GROUP BY 1")
def takeout_export(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    seen = events.groupBy("user_id").agg(F.count("*").alias("n"))
    lookup = events.where("user_id % 3 <> 0").select("user_id", F.concat(F.lit("t"), F.col("user_id") % 7).alias("title"), F.lit("a").alias("artist")).distinct()
    exported, _ = build.takeout_export(seen, "user_id", lookup, "title", "artist")
    return exported.select("user_id", "n", "lookup_status")


@query("SELECT o_orderkey, c_name AS customer, n_name AS nation FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey")
def review_context(spark: SparkSession, d: str) -> DataFrame:
    lookups = [(table(spark, d, "customer"), {"o_custkey": "c_custkey"}, {"c_name": "customer", "c_nationkey": "_nation"}), (table(spark, d, "nation"), {"_nation": "n_nationkey"}, {"n_name": "nation"})]
    return build.with_context(table(spark, d, "orders").select("o_orderkey", "o_custkey"), lookups).select("o_orderkey", "customer", "nation")


@query("SELECT p_partkey AS id, p_name AS fixed_title, CASE WHEN p_partkey % 2 = 0 THEN 'accepted_both_agree' ELSE 'accepted_first' END AS decision FROM part")
def text_repair(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    rows = table(spark, d, "part").select(c("p_partkey").alias("id"), c("p_name").alias("t"), c("p_brand").alias("a"), c("p_type").alias("l"), F.when(c("p_partkey") % 2 == 0, c("p_name")).otherwise("???").alias("t2"), F.when(c("p_partkey") % 2 == 0, c("p_brand")).otherwise("").alias("a2"))
    fields = {"title": "t", "artist": "a", "album": "l"}
    return build.repaired_rows(rows, fields, (fields, {"title": "t2", "artist": "a2", "album": "l"})).select("id", "fixed_title", "decision")


@query("SELECT p_partkey AS id, p_name AS title FROM part")
def zip_ingest(spark: SparkSession, d: str) -> DataFrame:
    """The catalog as CSV members of zip files, one from each batch of rows, read back."""
    path = new_path(spark, "archives")
    part = table(spark, d, "part").select("p_partkey", "p_name").repartition("p_partkey")

    def zipped(batches):
        import pyarrow as pa

        for batch in batches:
            body = io.BytesIO()
            with zipfile.ZipFile(body, "w") as archive:
                archive.writestr("list.csv", "\n".join(f"{i},{t}" for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)))
                archive.writestr("skipped.json", "{}")
            yield pa.RecordBatch.from_arrays([pa.array([body.getvalue()], pa.binary())], ["content"])

    part.mapInArrow(zipped, "content binary").write.parquet(path)
    files = spark.read.parquet(path).select(F.lit("x.zip").alias("path"), F.lit("zip").alias("extension"), "content")
    lines = tables.zip_members(files).select(F.explode(F.split(tables.decoded(F.col("content")), "\n")).alias("line")).where("line <> ''")
    return lines.select(F.get(F.split("line", ","), F.lit(0)).cast("long").alias("id"), F.get(F.split("line", ","), F.lit(1)).alias("title"))


@query("SELECT count(*) AS n_rows FROM part WHERE p_size > 5")
def guarded_write(spark: SparkSession, d: str) -> DataFrame:
    active = table(spark, d, "part")
    candidate = active.where("p_size > 5")
    root = new_path(spark, "guarded")
    reviewed = publish.publish(active, root, None)
    publish.guarded_publish(candidate, root, reviewed, tuple(tables.fingerprint(candidate).first()))
    return publish.read_version(spark, root).agg(F.count("*").alias("n_rows"))


@query("SELECT p_brand || ' — ' || p_name AS value, p_name AS artist, p_brand AS title, replace(p_brand, '#', '') AS playlist FROM part")
def playlist_lines(spark: SparkSession, d: str) -> DataFrame:
    """Files on disk, named after their playlists, several of one name in folders of their own."""
    path = new_path(spark, "playlists")
    lines = table(spark, d, "part").select(F.concat("p_brand", F.lit(" — "), "p_name").alias("value"), F.replace("p_brand", F.lit("#"), F.lit("")).alias("playlist"), F.pmod(F.xxhash64("p_partkey"), F.lit(4)).alias("part"))
    lines.repartition("playlist", "part").drop("part").write.partitionBy("playlist").text(f"{path}/written")
    tables.moved(spark, f"{path}/written/playlist=*/*.txt", lambda k, name: f"{path}/files/{k}/{name.rpartition('/')[0].rpartition('=')[2]}-videos.csv")
    return tables.playlist_lines(spark.read.text(f"{path}/files/*/*-videos.csv")).select("value", "artist", "title", "playlist")


