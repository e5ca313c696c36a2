"""Official patches end to end: stale and repeated patches, rows that are missing or doubled, against a loop."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from curatrix.operators import official
from curatrix.operators.official import official_outcomes, official_patches, officially_patched

CATALOG = [(1, "Electric Avenue", "Eddy Grant", "Old", ""), (2, "Doubled", "X", "a", "b"), (3, "Doubled", "x", "c", "d"), (4, "Alone", "Somebody", "", None), (5, "Twice", "A", "p", "q"), (6, "Twice", "B", "r", "s")]


def catalog(spark):
    return spark.createDataFrame(CATALOG, "row_key long, Title string, Artist string, Album string, `Spotify ID` string")


def entities(spark):
    rows = [("e1", "electric avenue", "EDDY GRANT"), ("e2", "Doubled", "X"), ("e4", "Alone", "Other"), ("e5", "Twice", "Z"), ("e9", "None Such", "Q"), ("e6", "Twice", "B")]
    return spark.createDataFrame(rows, "entity_id string, seed_title string, seed_artist string")


def promotions(spark, rows):
    return spark.createDataFrame([(f"p{i}", i, e, f, v, j) for i, (e, f, v, j) in enumerate(rows)], "promotion_id string, order int, entity_id string, target_field string, promoted_value string, evidence_json string")


def test_export(spark):
    p = promotions(spark, [("e1", "title", "Electric Avenue", '{"supporting_sources": "iTunes:1"}'), ("e1", "spotify_track_id", "t1", "bad"), ("e2", "album", "n", None), ("e4", "album", "n", None), ("e5", "album", "n", None), ("e9", "album", "n", None), ("gone", "mood", "n", None), ("e6", "album", "r", None)])
    got = {r["promotion_id"]: (r["official_match_status"], r["target_column"], r["current_value"], r["patch_action"]) for r in official_patches(p, entities(spark), catalog(spark), "row_key").collect()}
    assert got == {
        "p0": ("matched_exact_title_artist", "Title", "Electric Avenue", "no_change"),
        "p1": ("matched_exact_title_artist", "Spotify ID", "", "update_existing"),
        "p2": ("ambiguous_multiple_title_artist_matches", "Album", "a", "manual_match_required"),
        "p3": ("matched_title_only", "Album", "", "update_existing"),
        "p4": ("ambiguous_multiple_title_matches", "Album", "p", "manual_match_required"),
        "p5": ("not_found", "Album", "", "manual_match_required"),
        "p6": ("not_found", "mood", "", "manual_match_required"),
        "p7": ("matched_exact_title_artist", "Album", "r", "no_change"),
    }
    sources = official_patches(p, entities(spark), catalog(spark), "row_key").where("promotion_id in ('p0', 'p1')").orderBy("promotion_id").select("supporting_sources").collect()
    assert [r[0] for r in sources] == ["iTunes:1", ""]


def test_patches_in_order_are_those_of_a_loop(spark):
    rng = random.Random(7)
    titles = [(r[1], r[2]) for r in CATALOG] + [("Nowhere", "Q")]
    patches = []
    for n in range(400):
        t, a = rng.choice(titles)
        patches.append((f"p{n:03d}", n, t.upper(), a, rng.choice(["Album", "Album", "Spotify ID", "mood"]), rng.choice(["Old", "", "x", "y", "r"]), rng.choice(["x", "y", "Old"]), rng.choice(["update_existing"] * 4 + ["no_change"]), rng.choice([official.EXACT] * 4 + ["matched_title_only"])))
    names = "promotion_id string, order int, seed_title string, seed_artist string, target_column string, current_value string, promoted_value string, patch_action string, official_match_status string"
    df = spark.createDataFrame(patches, names).repartition(5)
    done = official_outcomes(catalog(spark), df, "row_key", "order")
    rows = {r[0]: {"Title": r[1], "Artist": r[2], "Album": r[3] or "", "Spotify ID": r[4] or ""} for r in CATALOG}
    log = {}
    for pid, _, t, a, column, seen, new, action, status in patches:
        if action != "update_existing" or status != official.EXACT:
            continue
        hits = [r for r in rows.values() if r["Title"].lower() == t.lower() and r["Artist"].lower() == a.lower()]
        if column not in ("Title", "Artist", "Album", "Spotify ID"):
            log[pid] = "missing_target_column"
        elif len(hits) != 1:
            log[pid] = "official_match_not_unique"
        elif hits[0][column] != seen:
            log[pid] = "stale_current_value"
        elif hits[0][column] == new:
            log[pid] = "already_current"
        else:
            log[pid], hits[0][column] = "applied", new
    assert {r["promotion_id"]: r["outcome"] for r in done.collect()} == log and set(log.values()) == {"missing_target_column", "official_match_not_unique", "stale_current_value", "already_current", "applied"}
    got = {r["row_key"]: r for r in officially_patched(catalog(spark), done, "row_key").collect()}
    assert {k: {c: got[k][c] or "" for c in rows[k]} for k in rows} == rows


def test_nothing_to_apply(spark):
    none = official_patches(promotions(spark, [("e1", "album", "x", None)]).where(F.lit(False)), entities(spark), catalog(spark), "row_key")
    done = official_outcomes(catalog(spark), none.withColumn("order", F.lit(1)), "row_key", "order")
    assert not done.collect() and officially_patched(catalog(spark), done, "row_key").count() == len(CATALOG)
