"""Operators on small tables with known results, and invariants."""

from __future__ import annotations

import zipfile

import pytest
from pyspark.sql import functions as F

from curatrix.functions import values
from curatrix.operators import dedupe, evidence, matching, profile, rows, similarity, versions
from curatrix.sources import tables
from curatrix.sources.session import ship_code
from curatrix.streaming import ledger


def test_duplicates_and_versions(spark):
    df = spark.createDataFrame([(1, "Hello", "Adele", ""), (2, "hello!", "ADELE", "Live"), (3, "Other", "Adele", "")], "id int, t string, a string, v string")
    groups = dedupe.duplicate_groups(df, values.stable_id(F.col("t"), F.col("a")), "id").collect()
    assert sorted((g["group_size"], g["id"]) for g in groups) == [(2, 1), (2, 2)]
    assert dedupe.group_sizes(df, values.stable_id(F.col("t"), F.col("a"), F.col("v"))).count() == 0


def test_similarity_v1(spark):
    df = spark.createDataFrame([(1, 120, "A", "Am", ["Rock", "Pop"]), (2, 122, "B", "C", ["Rock"]), (3, 140, "C", "D", [])], "id int, bpm int, artist string, key string, lists array<string>")
    got = similarity.top_similar(df, df.where("id = 1"), "id", similarity.reasons_likeness(), 10).select("b_id", "similarity_score", "reasons").collect()
    assert [tuple(r) for r in got] == [(2, 42.5, "Close BPM; Shared Playlists: Rock")]


def test_quality_counts(spark):
    df = spark.createDataFrame([("a", "x", "120"), ("b", "", ""), ("c", None, " ")], "t string, i string, b string")
    assert tuple(profile.missing_report(df, {"ids": rows.lacks_all(F.col("i")), "tempo": rows.lacks_all(F.col("b"))}).first()) == (3, 2, 2)


def test_vibe_search(spark):
    df = spark.createDataFrame([(1, "Underwater", "R%C3%9CF%C3%9CS DU SOL"), (2, "Underwater", "Other")], "id int, title string, artist string")
    ship_code(spark)
    assert [r["id"] for r in rows.vibe_search(df, "RÜFÜS Underwater", ["title", "artist"]).collect()] == [1]


def test_queue_steps(spark):
    seeds = spark.createDataFrame([("a",), ("b",), ("c",)], "e string")
    seen = spark.createDataFrame([("a", "f1"), ("c", "f1"), ("c", "f2")], "e string, f string")
    ids = spark.createDataFrame([("a", "Spotify"), ("a", "YouTube Music")], "e string, s string")
    got = evidence.verification_queue(seeds, seen, ids, "e", "f", "s", "Spotify", ["MusicBrainz", "iTunes", "YouTube Music"])
    assert {r["e"]: r["next_step"] for r in got.collect()} == {"a": "candidate_dual_source_match", "b": "seed_only", "c": "candidate_local_evidence_only"}


def test_identifiers_drop_placeholders(spark):
    df = spark.createDataFrame([("o1", {"Spotify Track ID": "sp-1", "MusicBrainz ID": "none", "Title": "x"})], "o string, raw map<string,string>")
    assert [(r["source_name"], r["field_value"]) for r in evidence.identifiers(df, "o", "raw").collect()] == [("Spotify", "sp-1")]


ATTEMPT = "e string, attempt_id int, provider string, verdict string, title_status string, artist_status string, album_status string, score long, album string"


def test_review_buckets(spark):
    data = [("strong", 1, "A", "matched", "exact", "exact", "exact", 990, "x"), ("strong", 2, "B", "matched", "exact", "exact", "exact", 950, "x"), ("album", 3, "A", "matched", "exact", "exact", "different", 900, "y"), ("clash", 4, "A", "needs_review", "different", "exact", "exact", 800, "z"), ("poor", 5, "A", "rejected", "different", "different", "different", 100, "w")]
    attempts = spark.createDataFrame(data, ATTEMPT)
    seeds = attempts.select("e").distinct()
    got = {r["e"]: r["review_bucket"] for r in evidence.entity_review(seeds, attempts, "e", "attempt_id").collect()}
    assert got == {"strong": "review_candidate_strong_identity", "album": "conflict_album_only", "clash": "conflict_identity", "poor": "insufficient_match"}
    albums = evidence.promotion_candidates(attempts, "e", {"album": "album"}).collect()
    assert {r["e"] for r in albums} == {"strong"} and albums[0]["supporting_sources"] == "A,B"


def catalog_of(spark, *data):
    return spark.createDataFrame([(k, *d) for k, d in enumerate(data)], "id int, title string, artist string, album string")


def test_waterfall_and_patch(spark):
    official = catalog_of(spark, ("Song", "Abba", "Gold"), ("Dup", "X", ""), ("Dup", "X", ""), ("Solo", "Y", ""))
    queries = spark.createDataFrame([("Song", "Abba"), ("Dup", "X"), ("Solo", "Z"), ("None", "Q")], "t string, a string")
    got = matching.match_waterfall(queries, "t", F.col("t"), F.col("a"), official, "id", F.col("title"), F.col("artist"))
    assert {r["t"]: r["official_match_status"] for r in got.collect()} == {"Song": "matched_exact_title_artist", "Dup": "matched_exact_ambiguous", "Solo": "matched_title_only", "None": "not_found"}


def test_diff_with_itself_is_empty(spark):
    df = catalog_of(spark, ("Song", "Abba", "Gold"), ("Song", "Abba", "Gold"), ("Other", "X", ""))
    assert rows.multiset_difference(df, df, ["title", "artist"], ["id"]).count() == 0
    assert versions.field_differences(df, df, ["title", "artist"], ["album"], {}).count() == 0
    one = df.limit(1)
    assert rows.multiset_difference(df, one, ["title", "artist"], ["id"]).count() == 2


def test_patches_twice(spark):
    table = spark.createDataFrame([(1, "k1", "old"), (2, "k2", "other"), (3, "k3", "a"), (4, "k3", "a")], "row_key long, k string, v string")
    schema = "patch_id string, seq int, match_column string, match_value string, target_column string, old_value string, new_value string"
    manifest = spark.createDataFrame([("p1", 1, "k", "k1", "v", "old", "mid"), ("p2", 2, "k", "k1", "v", "mid", "new"), ("p3", 3, "k", "k2", "v", "wrong", "x"), ("p4", 4, "k", "k3", "v", "a", "b"), ("p5", 5, "q", "k1", "v", "", "x"), ("p6", 6, "k", "k1", "q", "", "x"), ("p7", 7, "k", "zz", "v", "", "x")], schema)
    first = {r["patch_id"]: r["outcome"] for r in versions.cell_patch_outcomes(table, manifest, ["k"], ["v"]).collect()}
    assert first == {"p1": "applied", "p2": "applied", "p3": "stale_current_value", "p4": "target_match_not_unique", "p5": "missing_match_column", "p6": "missing_target_column", "p7": "target_match_not_unique"}
    patched = versions.patched(table, versions.cell_patch_outcomes(table, manifest, ["k"], ["v"]), ["v"])
    assert sorted((r["row_key"], r["v"]) for r in patched.collect()) == [(1, "new"), (2, "other"), (3, "a"), (4, "a")]
    after = table.withColumn("v", F.when(F.col("k") == "k1", "new").otherwise(F.col("v")))
    again = {r["patch_id"]: r["outcome"] for r in versions.cell_patch_outcomes(after, manifest.where("patch_id = 'p2'"), ["k"], ["v"]).collect()}
    assert again == {"p2": "already_applied"}


def test_safe_merge_counts(spark):
    df = spark.createDataFrame([(1, "Song", "A", "Greatest Hits", 200, "x"), (2, "Song", "A", "First", 201, "y; x"), (3, "Song (Live)", "A", "L", 200, ""), (4, "Far", "B", "", 100, ""), (5, "Far", "B", "", 300, "")], "id int, title string, artist string, album string, secs int, tags string")
    order = dedupe.keeper_order(F.col("album"), F.lit(None).cast("int"), F.col("secs"), F.col("title"))
    merged, gone, review = dedupe.safe_merge(df, ["title", "artist"], "id", "title", F.col("secs"), order, ["album"], ["tags"])
    m = merged.collect()
    assert [(r["keeper_id"], r["album"], r["tags"], r["group_size"]) for r in m] == [(2, "First", "y; x", 2)]
    assert [r["id"] for r in gone.collect()] == [1] and {r["id"] for r in review.collect()} == {4, 5}


def test_patch_candidate_never_overwrites(spark):
    active = catalog_of(spark, ("Song", "Abba", ""), ("Solo", "Y", "Mine"))
    staged = catalog_of(spark, ("Song", "Abba", "Gold"), ("Solo", "Y", "Theirs"))
    patched, log = versions.patch_candidate(active, staged, ["title", "artist"], "id", ["album"])
    assert {r["id"]: r["album"] for r in patched.collect()} == {0: "Gold", 1: "Mine"}
    assert [tuple(r) for r in log.collect()] == [(0, "album", "", "Gold")]
    assert versions.overwrite_violations(log, active, "id", ["album"]).count() == 0


def test_id_status(spark):
    good = "a" * 22
    df = spark.createDataFrame([("", ""), (good, good), (good, "b"), ("short", ""), (good, "")], "l string, t string")
    assert [r[0] for r in df.select(versions.id_status(F.col("l"), F.col("t"))).collect()] == ["no_legacy_id", "already_same", "conflict_legacy_id_differs_from_track_id", "needs_review_invalid_id_shape", "safe_to_copy_legacy_id_to_track_id"]


def test_lists_and_archives(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "mix.txt").write_text("# note\nSusan Wong - Billie Jean\n\nJust a title\n")
    got = tables.text_list(spark.read.text(str(tmp_path / "in" / "mix.txt"))).select("artist", "title").collect()
    assert [tuple(r) for r in got] == [("Susan Wong", "Billie Jean"), ("", "Just a title")]
    with zipfile.ZipFile(tmp_path / "in" / "take.zip", "w") as z:
        z.writestr("a/list.csv", "Video ID,Title,Artist\nyt-1,T,A\n")
        z.writestr("a/skip.json", "{}")
        z.writestr("a/old.txt", "caf\xe9".encode("cp1252"))
    ship_code(spark)
    members = tables.zip_members(tables.files_under(spark, str(tmp_path / "in")))
    read = {r["member"]: r["t"] for r in members.select("member", tables.decoded(F.col("content")).alias("t")).collect()}
    assert read == {"a/list.csv": "Video ID,Title,Artist\nyt-1,T,A\n", "a/old.txt": "café"}


def test_csv_and_observations(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes('﻿Track Name,ARTIST,Album,BPM\n"So ""x""",A,,120.0\n'.encode())
    df = tables.read_csv(spark, str(tmp_path / "x.csv"))
    assert df.columns == ["Track Name", "ARTIST", "Album", "BPM"]
    o = tables.as_observations(df).first()
    assert (o["title"], o["artist"], o["album"], o["raw"]["BPM"]) == ('So "x"', "A", "", "120.0")
    assert tables.typed(df, {"BPM": ("bpm", "integer"), "Album": ("album", "string")}).first() == (120, None)
    assert tables.read_csv(spark, str(tmp_path / "none.csv"), ["a"]).count() == 0
    assert [r["row_number"] for r in tables.with_row_number(df).collect()] == [2]
    with pytest.raises(ValueError):
        tables.patch_manifest(df, ["patch_id"])


def test_new_keys_only(spark, tmp_path):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "k int, v string")
    tables.append_new(a, f"{tmp_path}/o", ["k"])
    tables.append_new(a.union(spark.createDataFrame([(3, "w")], "k int, v string")), f"{tmp_path}/o", ["k"])
    assert sorted(r["k"] for r in spark.read.parquet(f"{tmp_path}/o").collect()) == [1, 2, 3]


def test_streamed_keys(spark, tmp_path):
    for k in range(3):
        spark.createDataFrame([(1, k), (k, k)], "k int, v int").write.parquet(f"{tmp_path}/in/p{k}")
    stream = spark.readStream.schema("k int, v int").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    ledger.resume_stream(stream, f"{tmp_path}/out", f"{tmp_path}/mark", ["k"]).awaitTermination()
    assert sorted(r["k"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [0, 1, 2]


def test_alias_match_statuses(spark):
    index = spark.createDataFrame([(1, ["a", "b"]), (2, ["b"])], "hit int, keys array<string>")
    queries = spark.createDataFrame([("q1", ["a"]), ("q2", ["b"]), ("q3", ["z"])], "q string, ks array<string>")
    got = matching.alias_match(queries, "q", F.col("ks"), index, "hit", F.col("keys")).collect()
    assert {r["q"]: (r["match_status"], r["matched_hit"]) for r in got} == {"q1": ("matched", 1), "q2": ("ambiguous", None), "q3": ("unmatched", None)}


def test_decisions_apply_unless_one_is_unresolved(spark):
    table = spark.createDataFrame([(1, "a", "t"), (2, "b", "u")], "id int, v string, t string")
    actions = spark.createDataFrame([(1, "new", "update"), (2, "b", "already"), (3, "c", "append")], "id int, accepted string, action string")
    got = versions.decisions_applied(table, actions, "id", "v", "accepted")
    assert sorted(tuple(r) for r in got.collect()) == [(1, "new", "t"), (2, "b", "u"), (3, "c", None)]
    with pytest.raises(ValueError, match="unresolved"):
        versions.decisions_applied(table, actions.withColumn("action", F.lit("unresolved")), "id", "v", "accepted")


def test_group_sizes_and_row_numbers_with_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x")], "id int, k string")
    assert sorted((r["id"], r["group_size"]) for r in dedupe.with_group_size(df, ["k"]).collect()) == [(1, 2), (2, 2), (3, 1)]
    numbered = tables.with_row_number(df.repartition(3), start=2)
    assert sorted(r["row_number"] for r in numbered.collect()) == [2, 3, 4]
    assert tables.with_row_number(df.where("id > 9")).count() == 0
