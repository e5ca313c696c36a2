"""A catalog's songs, recordings, links, memberships, entities, identifiers and observations from one read of its rows.

`built` reads the rows once and writes them as one stream of tagged rows, a folder for each kind; every result is a
projection or one grouping of a few of these folders. What many rows share (a song, an artist) is reduced by min_by, which
combines before the shuffle, so a key that most rows have sends one row a task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import BLANKS, clean, display_text, first_nonblank, match_text, or_null, spaced_key, text_of
from ..functions.values import infer_version, listed, semicolon_join, short_id
from ..sources.session import new_path, spread

#: What a recording carries: its field -> the headers it is read from, the first that is filled.
HEADERS = {
    "title": ["Title", "Base Title"], "canonical_title": ["Base Title", "Title"], "artist": ["Artist"], "album": ["Album"], "duration": ["Duration"], "release_year": ["Year"],
    "genre": ["Genre", "Spotify Genre"], "bpm": ["BPM", "Spotify BPM"], "musical_key": ["Spotify Key Full", "Spotify Key"], "track_id": ["Spotify Track ID", "Spotify ID"], "legacy_id": ["Spotify ID"],
    "isrc": ["Spotify ISRC"], "recording_mbid": ["Spotify MusicBrainz ID"], "track_verified": ["Spotify Verified"], "mbid_verified": ["MusicBrainz Verified"], "playlists": ["Playlists"],
}
MOODS = ["Vibe", "Spotify Vibe", "Spotify Energy Level"]
#: Site -> start of a search, what is asked before title and artist, link type.
SITES = {
    "SecondHandSongs": ("https://www.google.com/search?q=", "site:secondhandsongs.com", "covers/originals/search"),
    "WhoSampled": ("https://www.google.com/search?q=", "site:whosampled.com", "samples/covers/remixes/search"),
    "Ultimate Guitar": ("https://www.ultimate-guitar.com/search.php?search_type=title&value=", "", "official_or_best_tab/search"),
}
LINK_STATUS = "search_link_generated"
#: Field of a recording -> name, source (blank: the catalog itself), kind of value, url and status (a field, or a word) of its identifier.
IDENTIFIERS = {
    "recording_id": ("Recording ID", "", "internal_id", "", "canonical"),
    "song_id": ("Song ID", "", "internal_id", "", "canonical"),
    "track_id": ("Spotify Track ID", "Spotify", "external_id", "", "track_verified"),
    "legacy_id": ("Legacy Spotify ID", "", "legacy_id", "", ""),
    "isrc": ("Spotify ISRC", "Spotify", "external_id", "", ""),
    "recording_mbid": ("MusicBrainz Recording ID", "MusicBrainz", "external_id", "https://musicbrainz.org/", "mbid_verified"),
}
COMMON = ["line", "recording_id", "song_id", "title", "artist", "album"]
DETAILS = [*[f for f in HEADERS if f not in (*COMMON, "playlists")], "mood_tags", "version"]
IDENTIFIER = ["entity_kind", "entity_id", "entity_label", "source", "field_name", "field_value", "value_kind", "source_url", "verified_status"]


def tagged_rows(rows: DataFrame, line: str, headers: dict[str, list[str]] = HEADERS, moods: list[str] = MOODS, sites: dict[str, tuple[str, str, str]] = SITES, observed: dict[tuple[str, str, str], list[str]] | None = None) -> DataFrame:
    """A row for each recording, link, membership and observation of rows: kind, COMMON, name, value, note, value_kind and (recordings only) details.

    line numbers the rows; observed has (source, note, kind of value) -> the columns whose filled cells are observed. Headers that rows lacks are blank."""
    cell = lambda names: first_nonblank(*[F.col(f"`{n}`") for n in names if n in rows.columns])
    cells = {(s, note, kind, h): F.regexp_replace(text_of(F.col(f"`{h}`")), rf"(?U)^[{BLANKS}]+|[{BLANKS}]+$", "") for (s, note, kind), names in (observed or {}).items() for h in names if h in rows.columns}
    mood = semicolon_join(F.array(F.lit(""), *[text_of(F.col(f"`{m}`")) for m in moods if m in rows.columns]))
    flat = rows.select(F.col(line).cast("long").alias("line"), *[cell(names).alias(f) for f, names in headers.items()], mood.alias("mood_tags"), *[c.alias(f"_o{k}") for k, c in enumerate(cells.values())])
    c = F.col
    flat = flat.withColumns({
        "song_id": short_id("S", spaced_key(c("canonical_title")), spaced_key(c("artist"))),
        "recording_id": short_id("R", spaced_key(c("title")), spaced_key(c("artist")), spaced_key(c("album")), c("duration"), c("track_id"), c("line")),
        "version": infer_version(c("title"), c("album")),
    })
    details = F.struct(*DETAILS)
    one = lambda kind, name="", value="", note="", value_kind="", more=None: F.struct(
        F.lit(kind).alias("kind"), *[(x if isinstance(x, Column) else F.lit(x)).alias(n) for n, x in (("name", name), ("value", value), ("note", note), ("value_kind", value_kind))],
        (F.when(F.lit(False), details) if more is None else more).alias("details"),
    )
    links = [one("link", s, F.concat(F.lit(base), F.url_encode(F.trim(F.concat_ws(" ", *[F.lit(a) for a in (asked,) if a], "title", "artist")))), link_type, LINK_STATUS) for s, (base, asked, link_type) in sites.items()]
    members = F.transform(listed(c("playlists"), ";,"), lambda p: one("membership", "playlist", clean(p)))
    seen = [F.when(c(f"_o{k}") != "", one("observation", F.lit(f"{s}\t{h}"), c(f"_o{k}"), note, kind)) for k, (s, note, kind, h) in enumerate(cells)]
    fixed = F.array_compact(F.array(one("recording", more=details), *links, *seen))
    return flat.select(*COMMON, F.inline(F.concat(fixed, members)))


@dataclass(frozen=True)
class Graph:
    """The results of one build, each a DataFrame over the tagged rows as they were written; own names the catalog as a source."""

    tagged: DataFrame
    own: str = "catalog"

    def _kind(self, kind: str) -> DataFrame:
        return self.tagged.where(F.col("kind") == kind)

    def recordings(self) -> DataFrame:
        """A row for each row of the catalog."""
        return self._kind("recording").select(*COMMON, "details.*")

    def songs(self) -> DataFrame:
        """A row for each song, from its first recording, and how many recordings it has."""
        kept = ["recording_id", "canonical_title", "artist", "album", "release_year", "genre", "mood_tags"]
        first = self.recordings().groupBy("song_id").agg(F.min_by(F.struct(*kept), "line").alias("f"), F.count("*").alias("n_recordings"))
        return first.select(
            "song_id", "f.canonical_title", F.col("f.artist").alias("canonical_artist"), F.col("f.recording_id").alias("primary_recording_id"), F.col("f.album").alias("preferred_release"),
            F.col("f.release_year").alias("first_published_year"), F.col("f.genre").alias("genre_family"), F.col("f.mood_tags").alias("default_mood_tags"), "n_recordings",
        )

    def links(self) -> DataFrame:
        """A search link of each recording for each site."""
        return self._kind("link").select("recording_id", "song_id", F.col("name").alias("site"), F.col("value").alias("search_url"), F.col("note").alias("link_type"), F.col("value_kind").alias("link_status"))

    def memberships(self) -> DataFrame:
        """A row for each playlist in a recording's cell, as often as it stands there."""
        return self._kind("membership").select("recording_id", "song_id", F.col("value").alias("playlist"))

    def observations(self) -> DataFrame:
        """A row for each filled cell of the observed columns."""
        part = lambda k: F.get(F.split("name", "\t", 2), F.lit(k))
        return self._kind("observation").select(F.col("line").cast("string").alias("row_number"), part(0).alias("source_name"), "title", "artist", "album", part(1).alias("field_name"), F.col("value").alias("field_value"), "value_kind", F.col("note").alias("notes"))

    def named_recordings(self) -> DataFrame:
        """Recordings whose blank title or artist is their song's; a title that is still blank is the recording's id.

        Only such rows are joined with the songs. They may nearly all be of one song: the join's other side has one row a song, so adaptive execution may split the hot partition."""
        rows = self.recordings()
        whole = rows.where("title <> '' AND artist <> ''")
        bare = rows.where("title = '' OR artist = ''").join(self.songs().select("song_id", F.col("canonical_title").alias("_title"), F.col("canonical_artist").alias("_artist")), "song_id")
        filled = bare.withColumns({"title": F.coalesce(or_null(F.col("title")), or_null(F.col("_title")), F.col("recording_id")), "artist": first_nonblank(F.col("artist"), F.col("_artist"))})
        return whole.unionByName(filled.drop("_title", "_artist").select(*rows.columns))

    def entities(self) -> DataFrame:
        """Songs, recordings, titles, artists and albums, each id once: the first row in the catalog's order names it."""
        c, none = F.col, F.lit("")
        columns = lambda df, kind, **given: df.select(F.lit(kind).alias("entity_kind"), *[given.get(n, none).alias(n) for n in ("entity_id", "display_name", "canonical_title", "canonical_artist", "album", "release_year", "primary_recording_id", "track_id", "recording_mbid")])
        songs = columns(self.songs(), "song", entity_id=c("song_id"), display_name=label(c("canonical_title"), c("canonical_artist"), c("song_id")), canonical_title=c("canonical_title"), canonical_artist=c("canonical_artist"), album=c("preferred_release"), release_year=c("first_published_year"), primary_recording_id=c("primary_recording_id"))
        named = self.named_recordings()
        recordings = columns(named, "recording", entity_id=c("recording_id"), display_name=label(c("title"), c("artist"), c("recording_id")), canonical_title=c("title"), canonical_artist=c("artist"), album=c("album"), release_year=c("release_year"), track_id=c("track_id"), recording_mbid=c("recording_mbid"))
        n = self.mentions()
        is_album, shown = c("entity_kind") == "album", display_text(c("label"))
        others = n.select(
            "entity_kind", "entity_id", F.when(shown == "", c("entity_id")).otherwise(shown).alias("display_name"), F.when(c("entity_kind") == "title", c("label")).otherwise("").alias("canonical_title"),
            F.when(c("entity_kind") == "title", "").otherwise(c("artist")).alias("canonical_artist"), F.when(is_album, c("label")).otherwise("").alias("album"), F.when(is_album, c("release_year")).otherwise("").alias("release_year"),
            c("recording_id").alias("primary_recording_id"), none.alias("track_id"), none.alias("recording_mbid"),
        )
        return songs.unionByName(recordings).unionByName(others)

    def mentions(self) -> DataFrame:
        """(entity_kind, entity_id, label, artist, release_year, recording_id) of titles, artists and albums, from the first recording that has each."""
        c = F.col
        one = lambda kind, prefix, col: F.when(c(col) != "", F.struct(F.lit(kind).alias("entity_kind"), short_id(prefix, match_text(c(col)), separator="|").alias("entity_id"), c(col).alias("label")))
        three = F.array_compact(F.array(one("title", "T", "title"), one("artist", "A", "artist"), one("album", "L", "album")))
        rows = self.named_recordings().select("line", "artist", "release_year", "recording_id", F.inline(three))
        return rows.groupBy("entity_kind", "entity_id").agg(F.min_by(F.struct("label", "artist", "release_year", "recording_id"), "line").alias("f")).select("entity_kind", "entity_id", "f.*")

    def identifiers(self) -> DataFrame:
        """What names each entity: ids of songs and recordings, names of titles, artists and albums, and urls."""
        c = F.col
        row = lambda *values: F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(n) for n, v in zip(IDENTIFIER, values, strict=True)])
        songs = self.songs().select(F.inline(F.array(row("song", c("song_id"), label(c("canonical_title"), c("canonical_artist"), c("song_id")), self.own, "Song ID", c("song_id"), "internal_id", "", ""))))
        field = F.when(c("entity_kind") == "title", "Canonical Title").when(c("entity_kind") == "artist", "Canonical Artist").otherwise("Album")
        names = self.mentions().select(F.inline(F.array(row(c("entity_kind"), c("entity_id"), c("label"), self.own, field, c("label"), "display_name", "", "canonical"))))
        shown = label(c("title"), c("artist"), c("recording_id"))
        ids = [F.when(c(f) != "", row("recording", c("recording_id"), shown, source or self.own, name, c(f), kind, url, c(status) if status in DETAILS else status)) for f, (name, source, kind, url, status) in IDENTIFIERS.items()]
        recordings = self.named_recordings().select(F.inline(F.array_compact(F.array(*ids))))
        bare = label(F.coalesce(F.nullif(c("title"), F.lit("")), c("recording_id")), c("artist"), c("recording_id"))
        urls = self._kind("link").select(F.inline(F.array(row("recording", c("recording_id"), bare, c("name"), F.concat("name", F.lit(" Search URL")), c("value"), "url", c("value"), c("value_kind")))))
        return reduce(DataFrame.unionByName, [songs, names, recordings, urls])

    def orphans(self) -> DataFrame:
        """(reference, n_rows, n_orphans): rows that refer to another result, and those whose reference is not there. A sound build has no orphans."""
        recordings, songs, entities = self.recordings().select("recording_id"), self.songs(), self.entities().select("entity_kind", "entity_id")
        references = {
            "recordings.song_id": (self.recordings().select("song_id"), songs.select("song_id")),
            "songs.primary_recording_id": (songs.select(F.col("primary_recording_id").alias("recording_id")), recordings),
            "links.recording_id": (self.links().select("recording_id"), recordings),
            "memberships.recording_id": (self.memberships().select("recording_id"), recordings),
            "identifiers.entity_id": (self.identifiers().select("entity_kind", "entity_id"), entities),
        }
        counted = []
        for name, (rows, targets) in references.items():
            keys = rows.groupBy(*rows.columns).count()  # a key that most rows refer to is one row of the join
            lost = keys.join(targets.select(*rows.columns, F.lit(0).alias("_lost")), rows.columns, "left")
            counted.append(lost.agg(F.lit(name).alias("reference"), F.coalesce(F.sum("count"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.when(F.col("_lost").isNull(), F.col("count"))), F.lit(0)).alias("n_orphans")))
        return reduce(DataFrame.unionByName, counted)


def label(title: Column, artist: Column, otherwise: Column) -> Column:
    """title - artist, the one that is filled, or else the third."""
    shown = F.concat_ws(" - ", F.nullif(title, F.lit("")), F.nullif(artist, F.lit("")))
    return F.when(shown == "", otherwise).otherwise(shown)


def built(rows: DataFrame, line: str, own: str = "catalog", **options) -> Graph:
    """The graph of rows, written once to the shared folder, a folder for each kind. Options as tagged_rows takes them.

    A task keeps a file of each kind open instead of sorting its rows by kind."""
    spark = rows.sparkSession
    tagged, path = tagged_rows(spread(rows), line, **options), new_path(spark, "graph")
    writers, former = "spark.sql.maxConcurrentOutputFileWriters", spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    spark.conf.set(writers, "8")
    try:
        tagged.write.partitionBy("kind").parquet(path)
    finally:
        spark.conf.set(writers, former)
    return Graph(spark.read.schema(tagged.schema).parquet(path), own)
