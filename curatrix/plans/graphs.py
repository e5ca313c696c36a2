"""Queries of the catalog and its reference graph, built from one read of `part` as a catalog with blank titles and artists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import graph
from .base import query, sql_match, table


def built(spark: SparkSession, d: str) -> graph.Graph:
    c = F.col
    key = c("p_partkey")
    rows = table(spark, d, "part").select(
        (key + 2).alias("line"), F.when(key % 19 != 0, c("p_name")).alias("Title"), F.when(key % 2 == 0, c("p_name")).alias("Base Title"), F.when(key % 17 == 0, " ").otherwise(c("p_brand")).alias("Artist"), c("p_type").alias("Album"),
        (c("p_size") + 1950).cast("string").alias("Year"), F.when(key % 3 == 0, F.concat(F.lit("trk"), key)).alias("Spotify Track ID"), F.concat(F.replace("p_name", F.lit(" "), F.lit(", ")), F.lit(";; "), "p_type").alias("Playlists"),
    )
    return graph.built(rows, "line", observed={("catalog", "Core Metadata", "metadata"): ["Title", "Base Title", "Artist", "Year"], ("Spotify", "Crosswalk", "id"): ["Spotify Track ID"]})


def key(c: str) -> str:
    return f"trim(regexp_replace(replace(lower({c}), '&', ' and '), '[^a-z0-9]+', ' ', 'g'))"


def hashed(prefix: str, text: str) -> str:
    return f"'{prefix}' || upper(sha1({text}))[:12]"


ROWS = f"""g AS (SELECT p_partkey, p_partkey + 2 AS line, CASE WHEN p_partkey % 19 <> 0 OR p_partkey % 2 = 0 THEN p_name ELSE '' END AS title, CASE WHEN p_partkey % 17 = 0 THEN '' ELSE p_brand END AS artist, p_type AS album,
    CAST(1950 + p_size AS VARCHAR) AS release_year, CASE WHEN p_partkey % 3 = 0 THEN 'trk' || p_partkey ELSE '' END AS track_id, p_name, p_brand FROM part),
  r AS (SELECT *, {hashed("S", f"{key('title')} || '␟' || {key('artist')}")} AS song_id, {hashed("R", f"{key('title')} || '␟' || {key('artist')} || '␟' || {key('album')} || '␟␟' || track_id || '␟' || line")} AS recording_id FROM g)"""
SONGS = """s AS (SELECT song_id, arg_min(title, line) AS canonical_title, arg_min(artist, line) AS canonical_artist, arg_min(recording_id, line) AS primary_recording_id, arg_min(album, line) AS preferred_release, arg_min(release_year, line) AS first_published_year, count(*) AS n_recordings FROM r GROUP BY 1),
  f AS (SELECT * REPLACE (CASE WHEN title = '' THEN recording_id ELSE title END AS title) FROM r)"""
LABEL = "CASE WHEN {t} = '' OR {a} = '' THEN coalesce(nullif({t} || {a}, ''), {otherwise}) ELSE {t} || ' - ' || {a} END"


def label(t: str, a: str, otherwise: str) -> str:
    return LABEL.format(t=t, a=a, otherwise=otherwise)


def mentioned(kind: str, prefix: str, c: str) -> str:
    return f"SELECT '{kind}' AS entity_kind, {hashed(prefix, sql_match(c))} AS entity_id, arg_min({c}, line) AS label, arg_min(artist, line) AS artist, arg_min(release_year, line) AS release_year, arg_min(recording_id, line) AS recording_id FROM f WHERE {c} <> '' GROUP BY 1, 2"


GRAPH = f"WITH {ROWS}, {SONGS}, m AS ({mentioned('title', 'T', 'title')} UNION ALL {mentioned('artist', 'A', 'artist')} UNION ALL {mentioned('album', 'L', 'album')})"
URLS = {
    "SecondHandSongs": ("https://www.google.com/search?q=", "site:secondhandsongs.com ", "covers/originals/search"), "WhoSampled": ("https://www.google.com/search?q=", "site:whosampled.com ", "samples/covers/remixes/search"),
    "Ultimate Guitar": ("https://www.ultimate-guitar.com/search.php?search_type=title&value=", "", "official_or_best_tab/search"),
}
LINKS = "l AS (" + " UNION ALL ".join(f"SELECT recording_id, song_id, title, artist, '{site}' AS site, '{base}' || replace(url_encode(trim('{asked}' || title || ' ' || artist)), '%20', '+') AS search_url, '{kind}' AS link_type FROM r" for site, (base, asked, kind) in URLS.items()) + ")"
MEMBERS = "p AS (SELECT recording_id, song_id, unnest(list_concat(string_split(p_name, ' '), [album])) AS playlist FROM r)"


@query(f"{GRAPH} SELECT * FROM s")
def graph_songs(spark: SparkSession, d: str) -> DataFrame:
    return built(spark, d).songs().drop("genre_family", "default_mood_tags")


@query(f"{GRAPH} SELECT line, recording_id, song_id, title, artist, album, title AS canonical_title, release_year, track_id FROM r")
def graph_recordings(spark: SparkSession, d: str) -> DataFrame:
    return built(spark, d).recordings().select("line", "recording_id", "song_id", "title", "artist", "album", "canonical_title", "release_year", "track_id")


@query(f"{GRAPH}, {LINKS} SELECT recording_id, song_id, site, search_url, link_type, 'search_link_generated' AS link_status FROM l")
def graph_links(spark: SparkSession, d: str) -> DataFrame:
    return built(spark, d).links()


@query(f"{GRAPH}, {MEMBERS} SELECT * FROM p")
def graph_memberships(spark: SparkSession, d: str) -> DataFrame:
    return built(spark, d).memberships()


OBSERVED = {"Title": ("CASE WHEN p_partkey % 19 <> 0 THEN p_name ELSE '' END", 0), "Base Title": ("CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE '' END", 0), "Artist": ("artist", 0), "Year": ("release_year", 0), "Spotify Track ID": ("track_id", 1)}
SEEN = [("'catalog' AS source_name, 'metadata' AS value_kind, 'Core Metadata' AS notes"), ("'Spotify' AS source_name, 'id' AS value_kind, 'Crosswalk' AS notes")]


@query(f"{GRAPH} SELECT * FROM ({' UNION ALL '.join(f'''SELECT CAST(line AS VARCHAR) AS row_number, title, artist, album, {SEEN[k]}, '{h}' AS field_name, {v} AS field_value FROM r''' for h, (v, k) in OBSERVED.items())}) WHERE field_value <> ''")
def graph_observations(spark: SparkSession, d: str) -> DataFrame:
    return built(spark, d).observations()


ENTITIES = f"""e AS (SELECT 'song' AS entity_kind, song_id AS entity_id, {label("canonical_title", "canonical_artist", "song_id")} AS display_name, canonical_title, canonical_artist, preferred_release AS album, first_published_year AS release_year, primary_recording_id, '' AS track_id FROM s
  UNION ALL SELECT 'recording', recording_id, {label("title", "artist", "recording_id")}, title, artist, album, release_year, '', track_id FROM f
  UNION ALL SELECT entity_kind, entity_id, label, CASE entity_kind WHEN 'title' THEN label ELSE '' END, CASE entity_kind WHEN 'title' THEN '' ELSE artist END, CASE entity_kind WHEN 'album' THEN label ELSE '' END, CASE entity_kind WHEN 'album' THEN release_year ELSE '' END, recording_id, '' FROM m)"""


@query(f"{GRAPH}, {ENTITIES} SELECT * FROM e")
def graph_entities(spark: SparkSession, d: str) -> DataFrame:
    return built(spark, d).entities().drop("recording_mbid")


IDENTIFIERS = f"""i AS (SELECT 'song' AS entity_kind, song_id AS entity_id, {label("canonical_title", "canonical_artist", "song_id")} AS entity_label, 'catalog' AS source, 'Song ID' AS field_name, song_id AS field_value, 'internal_id' AS value_kind, '' AS source_url, '' AS verified_status FROM s
  UNION ALL SELECT entity_kind, entity_id, label, 'catalog', CASE entity_kind WHEN 'title' THEN 'Canonical Title' WHEN 'artist' THEN 'Canonical Artist' ELSE 'Album' END, label, 'display_name', '', 'canonical' FROM m
  UNION ALL SELECT 'recording', recording_id, {label("title", "artist", "recording_id")}, 'catalog', 'Recording ID', recording_id, 'internal_id', '', 'canonical' FROM f
  UNION ALL SELECT 'recording', recording_id, {label("title", "artist", "recording_id")}, 'catalog', 'Song ID', song_id, 'internal_id', '', 'canonical' FROM f
  UNION ALL SELECT 'recording', recording_id, {label("title", "artist", "recording_id")}, 'Spotify', 'Spotify Track ID', track_id, 'external_id', '', '' FROM f WHERE track_id <> ''
  UNION ALL SELECT 'recording', recording_id, {label("coalesce(nullif(title, ''), recording_id)", "artist", "recording_id")}, site, site || ' Search URL', search_url, 'url', search_url, 'search_link_generated' FROM l)"""


@query(f"{GRAPH}, {LINKS}, {IDENTIFIERS} SELECT entity_kind, entity_id, entity_label, source, field_name, field_value, value_kind, source_url, verified_status FROM i")
def graph_identifiers(spark: SparkSession, d: str) -> DataFrame:
    """Here a recording with a track's id has no legacy one."""
    return built(spark, d).identifiers().where("field_name <> 'Legacy Spotify ID'")


@query(f"""{GRAPH}, {LINKS}, {MEMBERS}, {ENTITIES}, {IDENTIFIERS} SELECT 'recordings.song_id' AS reference, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_orphans FROM r UNION ALL SELECT 'songs.primary_recording_id', count(*), 0 FROM s UNION ALL SELECT 'links.recording_id', count(*), 0 FROM l
  UNION ALL SELECT 'memberships.recording_id', count(*), 0 FROM p UNION ALL SELECT 'identifiers.entity_id', count(*), 0 FROM i""")
def graph_references(spark: SparkSession, d: str) -> DataFrame:
    """Rows of all results of one build that refer to another, none of them in vain."""
    return built(spark, d).orphans()
