"""The catalog and its reference graph against a plain build of the same rows, one after another; readings of titles."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

from curatrix.operators import catalog, graph

ROWS = [
    (2, "Song A", None, " X ", "Alb; One", "p1; p2, p1,;", "1990", "t1"),
    (3, "song  a", "Song A!", "x", "Alb", "", None, ""),
    (4, "", " ", "Y", "", "p3", "", None),  # its song is the next row's, whose title has no letter
    (5, None, None, "Y", None, None, None, " t2 "),
    (6, None, "", None, " ", ",", "", ""),  # nothing at all
    (7, "Café (Live)", "", "The Ärzte", "alb", "p1", "2001", "t1"),
    (8, "Song A", None, " X ", "Alb; One", "p1; p2, p1,;", "1990", "t1"),  # a row that stands twice
    (9, "!!!", "", "", "", "", "", ""),
    (10, "", "", "", "", "", "", ""),
]
SCHEMA = "n int, Title string, `Base Title` string, Artist string, Album string, Playlists string, Year string, `Spotify Track ID` string"
OBSERVED = {("own", "core", "metadata"): ["Title", "Album", "Absent"], ("other", "", "id"): ["Spotify Track ID"]}


def clean(x):
    return " ".join((x or "").split())


def key(x):
    return clean(re.sub("[^a-z0-9]+", " ", x.lower().replace("&", " and ")))


def digest(prefix, *parts, by="␟"):
    return prefix + hashlib.sha1(by.join(parts).encode()).hexdigest()[:12].upper()


def plain(rows):
    songs, recordings, members, seen = {}, [], Counter(), Counter()
    for n, *cells in rows:
        title, base, artist, album, playlists, year, track = map(clean, cells)
        shown, canonical = title or base, base or title
        song = digest("S", key(canonical), key(artist))
        recording = digest("R", key(shown), key(artist), key(album), "", track, str(n))
        songs.setdefault(song, [canonical, artist, recording, album, year, 0])[5] += 1
        recordings.append((n, recording, song, shown, artist, album, year, track))
        members.update((recording, p) for p in map(clean, re.split("[;,]", playlists)) if p)
        own = [("own", "Title", (cells[0] or "").strip()), ("own", "Album", (cells[3] or "").strip()), ("other", "Spotify Track ID", (cells[6] or "").strip())]
        seen.update((str(n), s, shown, f, v) for s, f, v in own if v)
    named = [(r, t or songs[s][0] or r, a or songs[s][1], al, y) for _, r, s, t, a, al, y, _ in recordings]
    return songs, recordings, members, seen, named


def test_graph(spark):
    songs, recordings, members, seen, named = plain(ROWS)
    g = graph.built(spark.createDataFrame(ROWS, SCHEMA).repartition(3), "n", own="own", observed=OBSERVED)
    assert sorted(tuple(r) for r in g.recordings().select("line", "recording_id", "song_id", "title", "artist", "album", "release_year", "track_id").collect()) == recordings
    assert {r[0]: list(r[1:]) for r in g.songs().drop("genre_family", "default_mood_tags").collect()} == songs
    assert Counter((r["recording_id"], r["playlist"]) for r in g.memberships().collect()) == members
    assert Counter((r["row_number"], r["source_name"], r["title"], r["field_name"], r["field_value"]) for r in g.observations().collect()) == seen
    assert Counter(r["recording_id"] for r in g.links().collect()) == Counter({r[1]: 3 for r in recordings})
    entities = {(r["entity_kind"], r["entity_id"]): r for r in g.entities().collect()}
    assert len(entities) == g.entities().count()
    for r, t, a, _, _ in named:
        assert (entities["recording", r]["canonical_title"], entities["recording", r]["canonical_artist"]) == (t, a)
        assert entities["recording", r]["display_name"] == (f"{t} - {a}" if a else t)
    firsts = {}
    for _, t, a, al, y in named:
        for kind, x in (("title", t), ("artist", a), ("album", al)):
            if x:
                firsts.setdefault((kind, x.lower()), (x, y if kind == "album" else ""))
    got = {(k, r["canonical_title"] or r["album"] or r["canonical_artist"], r["release_year"]) for (k, _), r in entities.items() if k in ("title", "artist", "album")}
    assert got == {(k, x, y) for (k, _), (x, y) in firsts.items()} and sum(k in ("title", "artist", "album") for k, _ in entities) == len(firsts)
    ids = Counter(r["field_name"] for r in g.identifiers().collect())
    assert ids == {"Song ID": len(songs) + len(recordings), "Recording ID": len(recordings), "Spotify Track ID": 4, "Canonical Title": sum(k == "title" for k, _ in firsts), "Canonical Artist": sum(k == "artist" for k, _ in firsts), "Album": sum(k == "album" for k, _ in firsts), **{f"{s} Search URL": len(recordings) for s in graph.SITES}}
    assert {r["source"] for r in g.identifiers().where("field_name = 'Song ID'").collect()} == {"own"}
    assert all(r["n_orphans"] == 0 for r in g.orphans().collect())


def test_graph_finds_lost_references(spark):
    g = graph.built(spark.createDataFrame(ROWS, SCHEMA), "n")
    torn = graph.Graph(g.tagged.where("NOT (kind = 'recording' AND line = 3)"))
    lost = {r["reference"]: (r["n_rows"], r["n_orphans"]) for r in torn.orphans().collect()}
    assert lost["links.recording_id"] == (27, 3) and lost["identifiers.entity_id"][1] == 3 and lost["recordings.song_id"][1] == 0


def test_graph_of_nothing_and_of_missing_columns(spark):
    g = graph.built(spark.createDataFrame([], SCHEMA), "n", observed=OBSERVED)
    assert all(getattr(g, x)().count() == 0 for x in ("songs", "recordings", "links", "memberships", "observations", "entities", "identifiers"))
    assert [(r["n_rows"], r["n_orphans"]) for r in g.orphans().collect()] == [(0, 0)] * 5
    g = graph.built(spark.createDataFrame([(1, "a")], "n int, Title string"), "n")
    assert [(r["title"], r["artist"]) for r in g.recordings().collect()] == [("a", "")] and g.memberships().count() == 0


def test_graph_is_one_write_that_results_read_in_part(spark):
    g = graph.built(spark.createDataFrame(ROWS, SCHEMA), "n")
    plan = g.links()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "kind" in plan.partition("PartitionFilters")[2].partition("]")[0]
    assert "details" not in plan.partition("ReadSchema")[2]


def test_readings_of_a_title_with_guest_and_noise(spark):
    df = spark.createDataFrame([(1, "A ft. B (Official Video)", "X | Y"), (2, "plain", ""), (3, " - ", "z"), (4, None, None)], "id int, t string, a string")
    got = {}
    for r in catalog.title_candidates(df, "t", "a").orderBy("id", "position").collect():
        got.setdefault(r["id"], []).append((r["cand_title"], r["cand_artist"], r["note"]))
    raw, guest = "A ft. B (Official Video)", "B (Official Video)"
    assert got[1] == [
        ("A ft. B", "X", "current_cleaned"), (raw, "X", "raw_title_cleaned_artist"), ("A ft. B", "X | Y", "cleaned_title_raw_artist"),
        ("A", "B", "feat_split"), ("A", guest, "feat_split_artist_raw"), ("A", "B", "feat_split_title_raw"),
        ("B", "A", "feat_split_reversed"), ("B", "A", "feat_split_reversed_artist_raw"), (guest, "A", "feat_split_reversed_title_raw"), ("A ft. B", "X", "title_noise_stripped"),
    ]
    assert [x[2] for x in got[2]] == ["current_cleaned", "raw_title_cleaned_artist", "cleaned_title_raw_artist"]
    assert 4 not in got and [x[0] for x in got[3]] == ["-", "-", "-"]
