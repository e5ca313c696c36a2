"""Promotions of an entity's fields as patches of an official catalog, and those patches applied to it.

Export: promotions meet their entities by id, entities meet the official catalog by title and artist (rolled up by key first), and every
promotion becomes a patch with the column it would change, that column's value now, and what is to be done. Apply: the patches for one
row found exactly are put on that row in order, cell by cell, each only if the cell still has the value that the patch saw. A cell's patches are
read in order by one task, which holds the cell's value alone, however many there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import search_text, text_of
from ..functions.values import json_value, value_of
from .matching import match_waterfall

#: The official columns that hold a promoted field, in order of preference; other fields are columns themselves.
OFFICIAL_COLUMNS = {
    "title": ["Title"], "artist": ["Artist"], "album": ["Album"], "spotify_track_id": ["Spotify Track ID", "Spotify ID"],
    "musicbrainz_recording_id": ["MusicBrainz Recording ID", "MusicBrainz ID", "Spotify MusicBrainz ID"], "itunes_track_id": ["iTunes Track ID"], "isrc": ["Spotify ISRC", "ISRC"],
}
#: Match statuses of a patch.
STATUSES = {"matched_exact_ambiguous": "ambiguous_multiple_title_artist_matches", "matched_title_only_ambiguous": "ambiguous_multiple_title_matches"}
EXACT = "matched_exact_title_artist"
PATCH = ["promotion_id", "entity_id", "seed_title", "seed_artist", "official_match_status", "target_field", "target_column", "current_value", "promoted_value", "patch_action", "supporting_sources", "conflicting_sources"]


def target_column(field: Column, columns: list[str], names: dict[str, list[str]]) -> Column:
    """The official column of a promoted field: the first of its names that the catalog has, else its first name."""
    known = {f: next((c for c in cs if c in columns), cs[0]) for f, cs in names.items()}
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in known.items() for x in p]), field), field)


def official_patches(promotions: DataFrame, entities: DataFrame, official: DataFrame, row_key: str, title: str = "Title", artist: str = "Artist", names: dict[str, list[str]] = OFFICIAL_COLUMNS) -> DataFrame:
    """A patch (PATCH, with order if promotions have it) for each promotion (promotion_id, entity_id, target_field, promoted_value, evidence_json) of entities (entity_id, seed_title, seed_artist).

    A promotion whose entity is missing has blank seeds. official has one row for each row_key; of several hits the least row_key counts."""
    columns = [c for c in official.columns if c != row_key]
    seeds = entities.select("entity_id", text_of(F.col("seed_title")).alias("seed_title"), text_of(F.col("seed_artist")).alias("seed_artist"))
    rows = promotions.join(seeds, "entity_id", "left").withColumns({c: F.coalesce(c, F.lit("")) for c in ("seed_title", "seed_artist")})
    rows = match_waterfall(rows, "promotion_id", F.col("seed_title"), F.col("seed_artist"), official, row_key, F.col(title), F.col(artist), key=search_text)
    renamed = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in STATUSES.items() for x in p]), F.col("official_match_status")), F.col("official_match_status"))
    rows = rows.withColumns({"official_match_status": renamed, "target_field": text_of(F.col("target_field")), "promoted_value": text_of(F.col("promoted_value"))})
    rows = rows.withColumn("target_column", target_column(F.col("target_field"), columns, names))
    now = official.select(F.col(row_key).alias("_row"), F.struct(*[text_of(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(columns)]).alias("_now"))
    rows = rows.join(now, F.col("official_id") == F.col("_row"), "left")
    rows = rows.withColumn("current_value", F.coalesce(value_of({c: F.col(f"_now.c{i}") for i, c in enumerate(columns)}, F.col("target_column")), F.lit("")))
    by_hand = (F.col("official_match_status") == "not_found") | F.col("official_match_status").startswith("ambiguous")
    action = F.when(by_hand, "manual_match_required").when((F.col("current_value") == F.col("promoted_value")) & (F.col("current_value") != ""), "no_change").otherwise("update_existing")
    sources = {c: json_value(F.col("evidence_json"), c) for c in ("supporting_sources", "conflicting_sources")}
    return rows.withColumns({"patch_action": action} | sources).select(*PATCH, *[c for c in ("order",) if c in promotions.columns])


def approved_patches(patches: DataFrame) -> DataFrame:
    """Those that may change a row: updates of one row found by title and artist."""
    return patches.where((F.col("patch_action") == "update_existing") & (F.col("official_match_status") == EXACT))


def cells_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each patch's outcome, and the value of its cell after it; patches come cell by cell, in order."""
    cell, value = None, None
    for batch in batches:
        outcomes, after = [], []
        for row, column, now, seen, new in zip(*(batch.column(c).to_pylist() for c in ("_row", "target_column", "_now", "current_value", "promoted_value")), strict=True):
            if (row, column) != cell:
                cell, value = (row, column), now
            outcomes.append("stale_current_value" if value != seen else "already_current" if value == new else "applied")
            value = new if outcomes[-1] == "applied" else value
            after.append(value)
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("promotion_id", "_row", "target_column", "_order")], pa.array(outcomes, pa.string()), pa.array(after, pa.string())], ["promotion_id", "row_key", "target_column", "order", "outcome", "value_after"])


def official_outcomes(official: DataFrame, patches: DataFrame, row_key: str, order: str, title: str = "Title", artist: str = "Artist") -> DataFrame:
    """(promotion_id, row_key, target_column, order, outcome, value_after) of approved patches, in order: unknown columns, rows that are not found once, values that are stale or current already, or applied."""
    columns = [c for c in official.columns if c != row_key]
    key = lambda t, a: [search_text(t).alias("_t"), search_text(a).alias("_a")]
    sole = official.select(F.col(row_key).alias("_row"), *key(F.col(title), F.col(artist))).groupBy("_t", "_a").agg(F.count("*").alias("_hits"), F.min("_row").alias("_row")).where("_hits = 1").drop("_hits")
    asked = approved_patches(patches).select(F.col("promotion_id").cast("string").alias("promotion_id"), F.col(order).cast("long").alias("_order"), "target_column", "current_value", "promoted_value", *key(F.col("seed_title"), F.col("seed_artist")))
    found = asked.join(sole, ["_t", "_a"], "left")
    reason = F.when(~F.col("target_column").isin(columns), "missing_target_column").when(F.col("_row").isNull(), "official_match_not_unique")
    found = found.withColumns({"_reason": reason, "_row": F.col("_row").cast("long")})
    cells = official.select(F.col(row_key).cast("long").alias("_row"), F.inline(F.array(*[F.struct(F.lit(c).alias("target_column"), text_of(F.col(f"`{c}`")).alias("_now")) for c in columns])))
    good = found.where("_reason is null").join(cells, ["_row", "target_column"])
    done = good.repartition("_row", "target_column").sortWithinPartitions("_row", "target_column", "_order", "promotion_id").select("promotion_id", "_row", "target_column", "_order", "_now", "current_value", "promoted_value")
    done = done.mapInArrow(cells_in_order, "promotion_id string, row_key long, target_column string, order long, outcome string, value_after string")
    bad = found.where("_reason is not null").select("promotion_id", F.when(F.col("_reason") != "missing_target_column", F.lit(None)).otherwise(F.col("_row")).alias("row_key"), "target_column", F.col("_order").alias("order"), F.col("_reason").alias("outcome"), F.lit(None).cast("string").alias("value_after"))
    return done.unionByName(bad)


def officially_patched(official: DataFrame, outcomes: DataFrame, row_key: str) -> DataFrame:
    """official with what its last applied patch left in each cell; patched columns become text."""
    columns = [c for c in official.columns if c != row_key]
    last = lambda c: F.max(F.when(F.col("target_column") == c, F.struct("order", "promotion_id", "value_after"))).getField("value_after")
    new = outcomes.where("outcome = 'applied'").groupBy(F.col("row_key").alias("_row")).agg(*[last(c).alias(f"_new{i}") for i, c in enumerate(columns)])
    joined = official.join(new, F.col(row_key) == F.col("_row"), "left")
    return joined.select(row_key, *[F.coalesce(f"_new{i}", F.col(f"`{c}`").cast("string")).alias(c) for i, c in enumerate(columns)])
