"""Queries of joins, evidence, review and similarity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as x
from ..functions import values as v
from ..functions.fuzzy import core_score
from ..operators import fuzzy_join as fuzzy
from ..operators import dedupe, evidence, matching, rows, similarity
from .base import BOTH, CATALOG, catalog, query, staged, table


def pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of catalog rows on successive lines of an order, a seed and a result: as many as the lines, at any size. Search text, title cores and artist keys are made once a row, before rows are paired."""
    base = catalog(spark, d).drop("price")
    base = base.withColumns({f"{c}_search": x.search_text(F.col(c)) for c in ("title", "artist", "album")} | {"core": x.title_core(F.col("title")), "name": x.fuzzy_key(F.col("artist"))})
    line = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    next_ = line.toDF("_order", "_line", "b_id")
    both = line.join(next_, (F.col("l_orderkey") == F.col("_order")) & (F.col("l_linenumber") + 1 == F.col("_line")) & (F.col("l_partkey") != F.col("b_id")))
    both = both.select(F.col("l_partkey").alias("_a"), F.col("b_id").alias("_b")).distinct()
    a, b = base.toDF(*[f"a_{c}" for c in base.columns]), base.toDF(*[f"b_{c}" for c in base.columns])
    return both.join(a, F.col("_a") == F.col("a_id")).join(b, F.col("_b") == F.col("b_id")).drop("_a", "_b")


PAIRS = f"WITH {CATALOG}, ids AS (SELECT DISTINCT p.l_partkey AS a_id, q.l_partkey AS b_id FROM lineitem p JOIN lineitem q ON p.l_orderkey = q.l_orderkey AND p.l_linenumber + 1 = q.l_linenumber AND p.l_partkey <> q.l_partkey), pairs AS (SELECT a.id AS a_id, a.title AS a_title, a.artist AS a_artist, a.album AS a_album, b.id AS b_id, b.title AS b_title, b.artist AS b_artist, b.album AS b_album FROM ids JOIN catalog a ON a_id = a.id JOIN catalog b ON b_id = b.id)"
SEED = {"title": "a_title", "artist": "a_artist", "album": "a_album"}
RESULT = {"title": "b_title", "artist": "b_artist", "album": "b_album"}


def sql_agreement(a: str, b: str) -> str:
    return f"CASE WHEN {a} = {b} THEN 'exact' WHEN contains({a}, {b}) OR contains({b}, {a}) THEN 'partial' ELSE 'different' END"


@query(f"""{PAIRS}, s AS (SELECT a_id, b_id, {sql_agreement('lower(a_title)', 'lower(b_title)')} AS title_status, {sql_agreement("lower(replace(a_artist, '#', ''))", "lower(replace(b_artist, '#', ''))")} AS artist_status, {sql_agreement('lower(a_album)', 'lower(b_album)')} AS album_status FROM pairs),
  t AS (SELECT *, CAST(10 * (CASE title_status WHEN 'exact' THEN 55 WHEN 'partial' THEN 45 ELSE 0 END + CASE artist_status WHEN 'exact' THEN 35 WHEN 'partial' THEN 25 ELSE 0 END + CASE album_status WHEN 'exact' THEN 10 WHEN 'partial' THEN 5 ELSE 0 END) AS INTEGER) AS score FROM s)
  SELECT *, CASE WHEN score >= 900 THEN 'matched' WHEN score >= 720 THEN 'needs_review' ELSE 'rejected' END AS verdict FROM t""")
def provider_scores(spark: SparkSession, d: str) -> DataFrame:
    searched = [{f: f"{p}_{f}_search" for f in SEED} for p in "ab"]
    return matching.provider_scores(pairs(spark, d), *searched, key=lambda c: c).select("a_id", "b_id", "title_status", "artist_status", "album_status", "score", "verdict")


def sql_points(f: str) -> str:
    a, b = (f"regexp_replace(lower({p}_{f}), '[^a-z0-9]+', '', 'g')" for p in "ab")
    return f"CASE WHEN {a} = {b} THEN 6 WHEN contains({a}, {b}) OR contains({b}, {a}) THEN 4 ELSE 0 END"


@query(f"{PAIRS} SELECT a_id, b_id, CAST(p AS INTEGER) AS points, p >= 10 AS verified FROM (SELECT a_id, b_id, {sql_points('title')} + {sql_points('artist')} + CASE WHEN {sql_points('album')} = 6 THEN 2 ELSE 0 END AS p FROM pairs)")
def integer_scores(spark: SparkSession, d: str) -> DataFrame:
    return matching.integer_scores(pairs(spark, d), SEED, RESULT, x.compact_key).select("a_id", "b_id", "points", "verified")


@query()
def fuzzy_best_match(spark: SparkSession, d: str) -> DataFrame:
    return matching.fuzzy_best(pairs(spark, d), "a_id", ("a_core", "a_name"), ("b_core", "b_name"), ["b_id"], prepared=True).select("a_id", "b_id", F.round("match_score", 6).alias("match_score"))


def misspelt(spark: SparkSession, d: str) -> DataFrame:
    """Every hundredth row of the catalog, with a letter of its title lost and one doubled."""
    t = F.col("title")
    wrong = F.concat(F.substring(t, 1, 2), F.substring(t, 4, 5), F.substring(t, 8, 1000))
    return catalog(spark, d).where("id % 100 = 0").select(F.col("id").alias("query_id"), wrong.alias("title"), "artist")


@query()
def fuzzy_join(spark: SparkSession, d: str) -> DataFrame:
    """The best match of each misspelt row among all rows, found without a list of candidates."""
    found = fuzzy.fuzzy_join(misspelt(spark, d), "query_id", ("title", "artist"), catalog(spark, d), "id", ("title", "artist"), 0.9)
    return found.withColumn("match_score", F.round("match_score", 6))


@query()
def fuzzy_waterfall(spark: SparkSession, d: str) -> DataFrame:
    scored = pairs(spark, d).withColumn("match_score", core_score(F.col("a_core"), F.col("a_name"), F.col("b_core"), F.col("b_name")))
    ranked = scored.withColumns({"candidate_pos": F.col("b_id"), "provider_rank": F.col("b_id") % 2})
    return matching.provider_waterfall(ranked, "a_id", least=0.5).select("a_id", "b_id")


@query(f"{PAIRS} SELECT a_id, b_id FROM (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY pts DESC, b_id) AS n FROM (SELECT a_id, b_id, CASE WHEN a_artist = b_artist THEN 2 ELSE 0 END + CASE WHEN a_title = b_title THEN 1 ELSE 0 END AS pts FROM pairs)) WHERE n = 1")
def choose_hit(spark: SparkSession, d: str) -> DataFrame:
    return matching.choose_hit(pairs(spark, d), "a_id", {"artist": ("a_artist", "b_artist", 2), "title": ("a_title", "b_title", 1)}, ["b_id"]).select("a_id", "b_id")


@query(f"{PAIRS} SELECT a_id, b_id FROM pairs WHERE (lower(a_artist) = lower(b_artist) OR contains(lower(b_artist), lower(a_artist[:8])) OR contains(lower(a_artist), lower(b_artist[:8]))) AND (contains(lower(b_title), lower(a_title)) OR contains(lower(a_title), lower(b_title)) OR contains(lower(b_title), lower(a_title[:10])))")
def loose_hits(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    return pairs(spark, d).where(rows.loose_hit(c("a_title"), c("a_artist"), c("b_title"), c("b_artist"))).select("a_id", "b_id")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def pending_keys(spark: SparkSession, d: str) -> DataFrame:
    done = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return matching.pending(table(spark, d, "orders"), done, ["o_orderkey"]).select("o_orderkey", "o_custkey")


@query(f"{BOTH} SELECT id, title, artist FROM catalog WHERE (title, artist) NOT IN (SELECT title, artist FROM catalog WHERE bpm > 40) AND (title, album) NOT IN (SELECT title, artist FROM catalog WHERE bpm > 40)")
def originals_only(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    keys = v.match_keys([c("title")], [c("artist"), c("album")])
    covers = catalog(spark, d).where("bpm > 40").select(v.match_keys([c("title")], [c("artist")]).getItem(0).alias("key"))
    return matching.without_any_key(catalog(spark, d), "id", keys, covers, "key").select("id", "title", "artist")


@query(f"""{BOTH}, k AS (SELECT title, artist, min(id) AS least, max(id) AS most FROM catalog GROUP BY 1, 2)
  SELECT s.id, CASE WHEN k.least IS NULL THEN 'unmatched' WHEN least = most THEN 'matched' ELSE 'ambiguous' END AS match_status, CASE WHEN least = most THEN least END AS matched_hit FROM staged s LEFT JOIN k ON s.title = k.title AND s.artist = k.artist""")
def alias_match(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    index = catalog(spark, d).withColumnRenamed("id", "hit")
    keys = v.match_keys([c("title"), c("title")], [c("artist")])
    return matching.alias_match(staged(spark, d), "id", keys, index, "hit", keys).select("id", "match_status", "matched_hit")


@query(f"""{BOTH}, k AS (SELECT title || '|' || artist || '|' || album AS k, min(id) AS seed FROM catalog GROUP BY 1), f AS (SELECT title || '|' || artist || '|' AS k, min(id) AS seed FROM catalog WHERE bpm < 3 GROUP BY 1)
  SELECT s.id, coalesce(k.seed, f.seed) AS seed FROM staged s LEFT JOIN k ON k.k = s.title || '|' || s.artist || '|' || s.album LEFT JOIN f ON f.k = s.title || '|' || s.artist || '|'""")
def seed_match(spark: SparkSession, d: str) -> DataFrame:
    """Seeds by title, artist and album, else by a seed that has no album."""
    base, c = catalog(spark, d), F.col
    with_album = base.select(F.concat_ws("|", "title", "artist", "album").alias("k"), "id")
    without = base.where("bpm < 3").select(F.concat_ws("|", "title", "artist", F.lit("")).alias("k"), "id")
    index = with_album.unionByName(without).groupBy("k").agg(F.min("id").alias("seed"))
    exact, fallback = F.concat_ws("|", "title", "artist", "album"), F.concat_ws("|", "title", "artist", F.lit(""))
    return matching.fallback_match(staged(spark, d), index, exact, fallback, "k", "seed").select(c("id"), c("seed"))


@query("""SELECT q.p_partkey AS qid, i.p_partkey AS hit FROM part q JOIN part i ON replace(q.p_name, ' ', '') = replace(i.p_name, ' ', '') AND q.p_partkey % 100 = 0""")
def variant_hits(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    spaced = part.where("p_partkey % 100 = 0").select(F.col("p_partkey").alias("qid"), F.replace("p_name", F.lit(" "), F.lit("-")).alias("t"))
    index = part.select(F.col("p_partkey").alias("hit"), F.replace("p_name", F.lit(" "), F.lit("")).alias("t"))
    return matching.all_variant_hits(spaced, "qid", v.spacing_variants(F.col("t")), index, "hit", v.spacing_variants(F.col("t")))


@query(f"""{BOTH}, b AS (SELECT title, artist, count(*) AS n, min(id) AS i FROM catalog GROUP BY 1, 2), t AS (SELECT title, count(*) AS n, min(id) AS i FROM catalog GROUP BY 1)
  SELECT s.id, CASE WHEN b.n = 1 THEN 'matched_exact_title_artist' WHEN b.n > 1 THEN 'matched_exact_ambiguous' WHEN t.n = 1 THEN 'matched_title_only' WHEN t.n > 1 THEN 'matched_title_only_ambiguous' ELSE 'not_found' END AS official_match_status,
  coalesce(b.i, t.i) AS official_id FROM staged s LEFT JOIN b ON s.title = b.title AND s.artist = b.artist LEFT JOIN t ON s.title = t.title""")
def match_waterfall(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    return matching.match_waterfall(staged(spark, d), "id", c("title"), c("artist"), catalog(spark, d), "id", c("title"), c("artist")).select("id", "official_match_status", "official_id")


@query("""SELECT a.p_partkey AS original_id, a.p_brand AS original_artist, b.p_partkey AS cover_id, b.p_brand AS cover_artist FROM part a JOIN part b ON a.p_name = b.p_name AND a.p_brand <> b.p_brand WHERE a.p_partkey % 100 = 0""")
def covers_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The covers of every hundredth row, looked up in all."""
    return matching.cover_pairs(table(spark, d, "part"), F.col("p_name"), F.col("p_brand"), "p_partkey", F.col("p_partkey") % 100 == 0).drop("title_key")


# --- evidence

SOURCE_SQL = "CASE l_returnflag WHEN 'A' THEN 'Spotify' WHEN 'R' THEN 'MusicBrainz' ELSE 'Local' END"


@query(f"""WITH o AS (SELECT l_partkey, count(*) AS observation_count, count(DISTINCT l_suppkey) AS source_file_count FROM lineitem GROUP BY 1),
  i AS (SELECT l_partkey, count(*) AS identifier_count, string_agg(DISTINCT s, ',' ORDER BY s) AS identifier_sources, bool_or(s = 'Spotify') AS m, bool_or(s = 'MusicBrainz') AS x FROM (SELECT l_partkey, {SOURCE_SQL} AS s FROM lineitem WHERE l_linenumber = 1 AND l_quantity < 20) GROUP BY 1)
  SELECT p_partkey AS l_partkey, coalesce(observation_count, 0) AS observation_count, coalesce(source_file_count, 0) AS source_file_count, coalesce(identifier_count, 0) AS identifier_count, coalesce(identifier_sources, '') AS identifier_sources,
  CASE WHEN m AND x THEN 'candidate_dual_source_match' WHEN m THEN 'candidate_spotify_only' WHEN identifier_count > 0 THEN 'candidate_non_spotify_identifier' WHEN observation_count > 1 THEN 'candidate_local_evidence_only' ELSE 'seed_only' END AS next_step
  FROM part LEFT JOIN o ON p_partkey = o.l_partkey LEFT JOIN i ON p_partkey = i.l_partkey""")
def verification_queue(spark: SparkSession, d: str) -> DataFrame:
    lines, f = table(spark, d, "lineitem"), F.col("l_returnflag")
    source = F.when(f == "A", "Spotify").when(f == "R", "MusicBrainz").otherwise("Local")
    found = lines.where("l_linenumber = 1 AND l_quantity < 20").withColumn("source", source)
    seeds = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"))
    return evidence.verification_queue(seeds, lines, found, "l_partkey", "l_suppkey", "source", "Spotify", ["MusicBrainz"])


@query("""WITH q AS (SELECT p_partkey, CASE WHEN p_size > 30 THEN 'candidate_dual_source_match' WHEN p_size > 20 THEN 'seed_only' ELSE 'candidate_spotify_only' END AS next_step FROM part)
  SELECT p_partkey, next_step FROM q ORDER BY CASE next_step WHEN 'candidate_dual_source_match' THEN 1 WHEN 'candidate_spotify_only' THEN 2 ELSE 5 END, p_partkey LIMIT 500""")
def queue_order(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("p_size")
    queued = table(spark, d, "part").select("p_partkey", F.when(s > 30, "candidate_dual_source_match").when(s > 20, "seed_only").otherwise("candidate_spotify_only").alias("next_step"))
    return rows.page(queued, [rows.bucket_order(F.col("next_step"), evidence.NEXT_STEPS), "p_partkey"], 500)


ATTEMPTS = """attempts AS (SELECT l_partkey AS entity, l_orderkey * 10 + l_linenumber AS attempt_id, 'P' || (l_suppkey % 3) AS provider, CAST(500 + (l_orderkey * 7 + l_linenumber) % 500 AS BIGINT) AS score,
  CASE WHEN (l_orderkey * 7 + l_linenumber) % 500 >= 400 THEN 'matched' WHEN (l_orderkey * 7 + l_linenumber) % 500 >= 220 THEN 'needs_review' ELSE 'rejected' END AS verdict,
  CASE WHEN l_orderkey % 97 = 0 THEN 'different' ELSE 'exact' END AS title_status, CASE WHEN l_orderkey % 89 = 0 THEN 'different' ELSE 'partial' END AS artist_status, CASE WHEN l_orderkey % 13 = 0 THEN 'different' ELSE 'exact' END AS album_status, l_shipdate, l_quantity FROM lineitem)"""


def attempts(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    n = (c("l_orderkey") * 7 + c("l_linenumber")) % 500
    status = lambda k, other: F.when(c("l_orderkey") % k == 0, "different").otherwise(other)
    return table(spark, d, "lineitem").select(c("l_partkey").alias("entity"), (c("l_orderkey") * 10 + c("l_linenumber")).alias("attempt_id"), F.concat(F.lit("P"), c("l_suppkey") % 3).alias("provider"), (n + 500).alias("score"), F.when(n >= 400, "matched").when(n >= 220, "needs_review").otherwise("rejected").alias("verdict"), status(97, "exact").alias("title_status"), status(89, "partial").alias("artist_status"), status(13, "exact").alias("album_status"), "l_quantity")


ROLLUP = """rolled AS (SELECT entity, count(*) AS attempt_count, count(DISTINCT provider) AS provider_count, count(*) FILTER (verdict = 'matched') AS matched_attempts, count(*) FILTER (verdict = 'needs_review') AS needs_review_attempts, count(*) FILTER (verdict = 'rejected') AS rejected_attempts,
  count(*) FILTER (verdict <> 'rejected' AND title_status = 'different') AS title_conflicts, count(*) FILTER (verdict <> 'rejected' AND artist_status = 'different') AS artist_conflicts, count(*) FILTER (verdict <> 'rejected' AND album_status = 'different') AS album_conflicts,
  max(score) AS best_score, string_agg(DISTINCT provider, ',' ORDER BY provider) AS providers_checked FROM attempts GROUP BY 1)"""


@query(f"""WITH {ATTEMPTS}, {ROLLUP}, best AS (SELECT entity, provider AS best_provider, verdict AS best_verdict FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY score DESC, verdict, provider, attempt_id) AS n FROM attempts) WHERE n = 1)
  SELECT r.*, best_provider, best_verdict, CASE WHEN provider_count >= 2 AND matched_attempts >= 2 AND title_conflicts = 0 AND artist_conflicts = 0 AND best_score >= 900 THEN 'review_candidate_strong_identity' WHEN title_conflicts > 0 OR artist_conflicts > 0 THEN 'conflict_identity'
  WHEN album_conflicts > 0 THEN 'conflict_album_only' WHEN matched_attempts >= 1 THEN 'review_candidate_single_source' ELSE 'insufficient_match' END AS review_bucket FROM rolled r JOIN best b ON r.entity = b.entity""")
def entity_review_buckets(spark: SparkSession, d: str) -> DataFrame:
    seeds = table(spark, d, "part").select(F.col("p_partkey").alias("entity"))
    return evidence.entity_review(seeds, attempts(spark, d), "entity", "attempt_id")


@query(f"WITH {ATTEMPTS}, {ROLLUP} SELECT CASE WHEN matched_attempts < 2 OR title_conflicts + artist_conflicts + album_conflicts > 0 THEN 'ambiguous' ELSE 'clear' END AS bucket, count(*) AS n FROM rolled GROUP BY 1")
def bucket_counts(spark: SparkSession, d: str) -> DataFrame:
    rolled = evidence.attempt_rollup(attempts(spark, d), "entity")
    return rolled.groupBy(F.when(evidence.ambiguous(rolled), "ambiguous").otherwise("clear").alias("bucket")).agg(F.count("*").alias("n"))


@query(f"""WITH {ATTEMPTS}, u AS (SELECT * FROM attempts WHERE verdict <> 'rejected'),
  c AS (SELECT entity, count(*) FILTER (album_status = 'different') AS albums, coalesce(string_agg(DISTINCT CASE WHEN title_status = 'different' OR artist_status = 'different' THEN provider END, ',' ORDER BY CASE WHEN title_status = 'different' OR artist_status = 'different' THEN provider END), '') AS conflicting_sources FROM u GROUP BY 1),
  r AS (SELECT entity, provider, score, 'title' AS target_field, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS proposed_value FROM u WHERE verdict = 'matched' UNION ALL SELECT entity, provider, score, 'album', CAST(CAST(l_quantity AS BIGINT) % 3 AS VARCHAR) FROM u WHERE verdict = 'matched')
  SELECT r.entity, target_field, proposed_value, string_agg(DISTINCT provider, ',' ORDER BY provider) AS supporting_sources, max(score) AS best_score, any_value(conflicting_sources) AS conflicting_sources FROM r JOIN c ON r.entity = c.entity WHERE target_field <> 'album' OR albums = 0 GROUP BY 1, 2, 3""")
def promotion_candidates(spark: SparkSession, d: str) -> DataFrame:
    q = F.col("l_quantity").cast("bigint")
    rows_ = attempts(spark, d).withColumns({"t": q.cast("string"), "a": (q % 3).cast("string")})
    return evidence.promotion_candidates(rows_, "entity", {"title": "t", "album": "a"})


@query(f"WITH {ATTEMPTS} SELECT entity, attempt_id, CAST(place AS INTEGER) AS place FROM (SELECT entity, attempt_id, row_number() OVER (PARTITION BY entity ORDER BY score DESC, attempt_id) AS place FROM attempts WHERE verdict <> 'rejected' AND entity IN (SELECT p_partkey FROM part))")
def supporting_attempts(spark: SparkSession, d: str) -> DataFrame:
    wanted = table(spark, d, "part").select(F.col("p_partkey").alias("entity"))
    return evidence.supporting_attempts(attempts(spark, d), wanted, "entity", "attempt_id").select("entity", "attempt_id", "place")


@query(f"WITH {CATALOG} SELECT entity_kind, entity_id, min(label) AS label, count(*) AS n_rows FROM (SELECT 'title' AS entity_kind, 'T' || upper(sha1(lower(title)))[:12] AS entity_id, title AS label FROM catalog UNION ALL SELECT 'artist', 'A' || upper(sha1(lower(artist)))[:12], artist FROM catalog) GROUP BY 1, 2")
def reference_entities(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    return evidence.entity_rows(catalog(spark, d), {"title": ("T", [F.lower("title")], c("title")), "artist": ("A", [F.lower("artist")], c("artist"))}, ["id"])


@query("SELECT p_partkey AS l_partkey, array_to_string(list_distinct(list_concat([p_type], [])), '; ') || coalesce('; ' || flags, '') AS cell FROM part LEFT JOIN (SELECT l_partkey, string_agg(DISTINCT l_returnflag, '; ' ORDER BY l_returnflag) AS flags FROM lineitem GROUP BY 1) ON l_partkey = p_partkey")
def membership_fold(spark: SparkSession, d: str) -> DataFrame:
    base = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("cell"))
    return dedupe.fold_membership(base, table(spark, d, "lineitem").select("l_partkey", "l_returnflag"), "l_partkey", "l_returnflag", "cell")


# --- similarity

def tagged(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    return table(spark, d, "part").select(c("p_partkey").alias("id"), c("p_size").alias("bpm"), c("p_type").alias("key"), c("p_brand").alias("artist"), c("p_type").alias("genre"), v.listed(c("p_name"), " ").alias("lists"), v.listed(c("p_name"), " ").alias("tags"))


TAGGED = "t AS (SELECT p_partkey AS id, p_size AS bpm, p_type AS key, p_brand AS artist, list_distinct(string_split(p_name, ' ')) AS tags FROM part)"


@query(f"""WITH {TAGGED}, s AS (SELECT a.id AS a_id, b.id AS b_id, round(CASE WHEN abs(a.bpm - b.bpm) <= 5 THEN 30 WHEN abs(a.bpm - b.bpm) <= 10 THEN 15 ELSE 0 END + CASE WHEN a.key = b.key THEN 20 ELSE 0 END + CASE WHEN a.artist = b.artist THEN 25 ELSE 0 END
  + 25 * (len(list_intersect(a.tags, b.tags)) / len(list_distinct(list_concat(a.tags, b.tags)))), 2) AS similarity_score FROM t a, t b WHERE a.id % 100 = 0 AND b.id <> a.id)
  SELECT a_id, b_id, similarity_score, CAST(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY similarity_score DESC, b_id) AS place FROM s WHERE similarity_score > 0) WHERE place <= 50""")
def similar_v1(spark: SparkSession, d: str) -> DataFrame:
    base = tagged(spark, d)
    return similarity.top_similar(base, base.where("id % 100 = 0"), "id", similarity.reasons_likeness(), 50).select("a_id", "b_id", "similarity_score", "place")


@query(f"""WITH {TAGGED}, s AS (SELECT a.id AS a_id, b.id AS b_id, 10.0::DOUBLE * (1.0::DOUBLE - abs(a.bpm - b.bpm)::DOUBLE / 15.0::DOUBLE) AS bpm_raw, abs(a.bpm - b.bpm) AS gap, CASE WHEN a.key = b.key THEN 10.0::DOUBLE ELSE 0.0::DOUBLE END AS same_key, 10.0::DOUBLE * (len(list_intersect(a.tags, b.tags))::DOUBLE / len(list_distinct(list_concat(a.tags, b.tags)))::DOUBLE) AS tag_score FROM t a, t b WHERE a.id % 100 = 0 AND a.id <> b.id),
  w AS (SELECT a_id, b_id, round(CASE WHEN gap <= 15 THEN bpm_raw ELSE 0 END + same_key + tag_score, 4) AS total_score FROM s)
  SELECT a_id, b_id, total_score, CAST(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY total_score DESC, b_id) AS place FROM w WHERE total_score > 3) WHERE place <= 5""")
def similar_v2(spark: SparkSession, d: str) -> DataFrame:
    """Key and genre are the same column here: 5 points each."""
    base = tagged(spark, d)
    return similarity.top_similar(base, base.where("id % 100 = 0"), "id", similarity.breakdown_likeness(), 5).select("a_id", "b_id", "total_score", "place")
