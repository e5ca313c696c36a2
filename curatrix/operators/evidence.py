"""Evidence about entities: observations, identifiers, verification queues, review buckets and promotions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean, is_blank, nonblank, search_text, text_of
from ..functions.values import hashed_id, seed_id
from .rows import first_per_key

#: Steps of the queue and buckets of the review, in their order.
NEXT_STEPS = ["candidate_dual_source_match", "candidate_spotify_only", "candidate_non_spotify_identifier", "candidate_local_evidence_only", "seed_only"]
BUCKETS = ["review_candidate_strong_identity", "review_candidate_single_source", "conflict_album_only", "conflict_identity", "insufficient_match"]
#: Header patterns of identifiers, the first that fits; values that stand for none.
IDENTIFIERS = [("Spotify", r"(?i)spotify.*(?:track|id)"), ("MusicBrainz", r"(?i)musicbrainz|mbid"), ("iTunes", r"(?i)itunes|apple"), ("YouTube Music", r"(?i)youtube|video.?id"), ("Discogs", r"(?i)discogs"), ("ISRC", r"(?i)isrc")]
PLACEHOLDERS = ["none", "null", "n/a", "nan", "-", "unknown"]


def seed_entities(df: DataFrame, title: str, artist: str, album: str, order: list[str]) -> DataFrame:
    """The first row of each named title, artist and album, with its seed id."""
    named = df.where(nonblank(F.col(title)) & nonblank(F.col(artist)))
    named = named.withColumns({"seed_key": F.concat_ws("|", *[search_text(F.col(c)) for c in (title, artist, album)]), "seed_id": seed_id(F.col(title), F.col(artist), F.col(album))})
    return first_per_key(named, ["seed_key"], order)


def observations(df: DataFrame, file_id: Column, row_number: Column, title: str, artist: str, album: str) -> DataFrame:
    """Distinct observations with their ids."""
    return df.withColumn("observation_id", hashed_id(file_id, row_number, F.col(title), F.col(artist), F.col(album))).dropDuplicates(["observation_id"])


def identifiers(df: DataFrame, observation_id: str, raw: str) -> DataFrame:
    """(observation, field, value, source) of a raw map's cells whose headers name an identifier, without placeholders."""
    cells = df.select(observation_id, F.explode(raw).alias("field_name", "field_value"))
    source = F.lit(None).cast("string")
    for name, pattern in reversed(IDENTIFIERS):
        source = F.when(F.col("field_name").rlike(pattern), name).otherwise(source)
    rows = cells.withColumn("source_name", source).where(F.col("source_name").isNotNull() & nonblank(F.col("field_value")) & ~F.lower(clean(F.col("field_value"))).isin(PLACEHOLDERS))
    return rows.withColumn("identifier_id", hashed_id(F.col(observation_id), F.col("field_name"), F.col("field_value"))).dropDuplicates(["identifier_id"])


def next_step(has_main: Column, has_other: Column, n_identifiers: Column, n_observations: Column) -> Column:
    return F.when(has_main & has_other, NEXT_STEPS[0]).when(has_main, NEXT_STEPS[1]).when(n_identifiers > 0, NEXT_STEPS[2]).when(n_observations > 1, NEXT_STEPS[3]).otherwise(NEXT_STEPS[4])


def verification_queue(entities: DataFrame, observed: DataFrame, identified: DataFrame, key: str, file: str, source: str, main: str, others: list[str]) -> DataFrame:
    """entities with counts of their evidence and the next step. Both evidence tables are rolled up before the joins."""
    o = observed.groupBy(F.col(key).alias("_o")).agg(F.count("*").alias("observation_count"), F.count_distinct(file).alias("source_file_count"))
    i = identified.groupBy(F.col(key).alias("_i")).agg(F.count("*").alias("identifier_count"), F.array_join(F.sort_array(F.collect_set(source)), ",").alias("identifier_sources"), F.bool_or(F.col(source) == main).alias("_main"), F.bool_or(F.col(source).isin(others)).alias("_other"))
    joined = entities.join(o, F.col(key) == F.col("_o"), "left").join(i, F.col(key) == F.col("_i"), "left")
    zero, no = F.lit(0), F.lit(False)
    joined = joined.withColumns({c: F.coalesce(c, zero) for c in ("observation_count", "source_file_count", "identifier_count")}).withColumn("identifier_sources", F.coalesce("identifier_sources", F.lit("")))
    return joined.withColumn("next_step", next_step(F.coalesce("_main", no), F.coalesce("_other", no), F.col("identifier_count"), F.col("observation_count"))).drop("_o", "_i", "_main", "_other")


def attempt_rollup(attempts: DataFrame, key: str) -> DataFrame:
    """Counts of attempts (provider, verdict, title_status, artist_status, album_status, score in thousandths) by entity."""
    usable = F.col("verdict").isin("matched", "needs_review")
    conflict = lambda f: F.count_if(usable & (F.col(f"{f}_status") == "different")).alias(f"{f}_conflicts")
    return attempts.groupBy(key).agg(
        F.count("*").alias("attempt_count"), F.count_distinct("provider").alias("provider_count"), *[F.count_if(F.col("verdict") == v).alias(f"{v}_attempts") for v in ("matched", "needs_review", "rejected")],
        conflict("title"), conflict("artist"), conflict("album"), F.max("score").alias("best_score"), F.array_join(F.sort_array(F.collect_set("provider")), ",").alias("providers_checked"),
    )


def best_attempts(attempts: DataFrame, key: str, attempt_id: str) -> DataFrame:
    """Each entity's best attempt: by score, verdict, provider, then id."""
    return first_per_key(attempts, [key], [F.desc("score"), "verdict", "provider", attempt_id])


def review_bucket() -> Column:
    """The bucket of a rolled-up entity."""
    c = F.col
    clear = (c("title_conflicts") == 0) & (c("artist_conflicts") == 0)
    strong = (c("provider_count") >= 2) & (c("matched_attempts") >= 2) & clear & (c("best_score") >= 900)
    return F.when(strong, BUCKETS[0]).when(~clear, BUCKETS[3]).when(c("album_conflicts") > 0, BUCKETS[2]).when(c("matched_attempts") >= 1, BUCKETS[1]).otherwise(BUCKETS[4])


def entity_review(entities: DataFrame, attempts: DataFrame, key: str, attempt_id: str) -> DataFrame:
    """Entities with attempts: their counts, best attempt and bucket."""
    best = best_attempts(attempts, key, attempt_id).select(F.col(key).alias("_b"), F.col("provider").alias("best_provider"), F.col("verdict").alias("best_verdict"))
    rolled = attempt_rollup(attempts, key)
    return entities.join(rolled, key).join(best, F.col(key) == F.col("_b"), "left").drop("_b").withColumn("review_bucket", review_bucket())


def ambiguous(rolled: DataFrame) -> Column:
    """Fewer than two providers matched, or any field conflicts."""
    c = F.col
    return (c("matched_attempts") < 2) | (c("title_conflicts") + c("artist_conflicts") + c("album_conflicts") > 0)


def promotion_candidates(attempts: DataFrame, key: str, fields: dict[str, str], album: str = "album") -> DataFrame:
    """(entity, target_field, proposed_value, supporting_sources, conflicting_sources, best_score): the values that matched attempts give each field; an album only without album conflicts.

    fields: target field -> column of the attempts."""
    usable = attempts.where(F.col("verdict").isin("matched", "needs_review"))
    conflicts = usable.groupBy(F.col(key).alias("_c")).agg(F.count_if(F.col("album_status") == "different").alias("_albums"), F.sort_array(F.collect_set(F.when((F.col("title_status") == "different") | (F.col("artist_status") == "different"), F.col("provider")))).alias("_against"))
    cells = F.filter(F.array(*[F.struct(F.lit(f).alias("target_field"), clean(F.col(c)).alias("proposed_value")) for f, c in fields.items()]), lambda x: x["proposed_value"] != "")
    rows = usable.where(F.col("verdict") == "matched").select(key, "provider", "score", F.inline(cells))
    found = rows.groupBy(key, "target_field", "proposed_value").agg(F.array_join(F.sort_array(F.collect_set("provider")), ",").alias("supporting_sources"), F.max("score").alias("best_score"))
    joined = found.join(conflicts, F.col(key) == F.col("_c")).where((F.col("target_field") != album) | (F.col("_albums") == 0))
    return joined.withColumn("conflicting_sources", F.array_join("_against", ",")).drop("_c", "_albums", "_against")


def promotions(candidates: DataFrame, key: str, table: str, evidence: list[str]) -> DataFrame:
    """Approved candidates as promotions with hash ids and their evidence as JSON."""
    return candidates.withColumns({"promotion_id": hashed_id(F.col(key), F.lit(table), F.lit(key), F.col("target_field"), F.col("proposed_value")), "evidence_json": F.to_json(F.struct(*evidence))})


def supporting_attempts(attempts: DataFrame, wanted: DataFrame, key: str, attempt_id: str) -> DataFrame:
    """All usable attempts of the wanted entities, ranked by score in each."""
    rows = attempts.where(F.col("verdict").isin("matched", "needs_review")).join(wanted.select(key).distinct(), key, "left_semi")
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("score"), attempt_id)))


def first_provider_ids(attempts: DataFrame, key: str, entity_id: str, attempt_id: str) -> DataFrame:
    """Each provider's best id for an entity."""
    return first_per_key(attempts.where(nonblank(F.col(entity_id))), [key, "provider"], [F.desc("score"), attempt_id]).select(key, "provider", entity_id)


def repair_decision(repaired: Column, a: Column, b: Column, agree: Column) -> Column:
    """What to do with a repaired text, from two providers' confidences and their agreement."""
    both = (a >= 0.8) & (b >= 0.8) & (agree >= 0.9)
    return F.when(is_blank(repaired), "rejected_blank").when(both, "accepted_both_agree").when(a >= 0.85, "accepted_first").when(b >= 0.85, "accepted_second").otherwise("ambiguous")


def text_confidence(title: Column, artist: Column, album: Column) -> Column:
    return 0.5 * title + 0.3 * artist + 0.2 * album


def entity_rows(df: DataFrame, kinds: dict[str, tuple[str, list[Column], Column]], order: list[str]) -> DataFrame:
    """Distinct entities of several kinds: kind -> (id prefix, key parts, label), the first label of each id by order."""
    from ..functions.values import short_id

    structs = [F.struct(F.lit(k).alias("entity_kind"), short_id(p, *parts, separator="|").alias("entity_id"), text_of(label).alias("label")) for k, (p, parts, label) in kinds.items()]
    rows = df.select(*order, F.inline(F.array(*structs))).where(F.col("label") != "")
    return rows.groupBy("entity_kind", "entity_id").agg(F.min_by("label", F.struct(*order)).alias("label"), F.count("*").alias("n_rows"))
