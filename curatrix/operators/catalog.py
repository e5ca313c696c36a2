"""Building and enriching catalogs: songs and recordings, candidates of messy titles, covers, playlists and suggestions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fuzzy import indel_ratio, match_score
from ..functions.text import LETTER, clean, clean_artist, clean_title, looks_suspicious, match_text, nonblank, repaired, text_of
from ..functions.values import search_url, short_id, tags_in
from ..sources.session import spread
from .evidence import repair_decision, text_confidence
from .rows import first_per_key

SEPARATORS = (" - ", " | ", " : ")
ACCEPTED = 0.88


def songs(df: DataFrame, title: Column, artist: Column, row_id: str) -> tuple[DataFrame, DataFrame]:
    """(recordings: df with song_id, songs: the first recording of each)."""
    recordings = df.withColumn("song_id", short_id("S", match_text(title), match_text(artist)))
    return recordings, first_per_key(recordings, ["song_id"], [row_id]).withColumnRenamed(row_id, "primary_recording_id")


def with_song_defaults(recordings: DataFrame, song_rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """recordings whose blank columns take their song's value. columns: recording column -> song column."""
    defaults = song_rows.select(F.col("song_id").alias("_song"), *[F.col(b).alias(f"_d_{a}") for a, b in columns.items()])
    joined = recordings.join(defaults, F.col("song_id") == F.col("_song"), "left")
    return joined.withColumns({a: F.when(nonblank(F.col(a)), clean(F.col(a))).otherwise(text_of(F.col(f"_d_{a}"))) for a in columns}).select(*recordings.columns)


def title_candidates(df: DataFrame, title: str, artist: str) -> DataFrame:
    """df with a row for each reading of a messy title: position, cand_title, cand_artist, note. The first is the cleaned row itself.

    Notes are fixed values: of a title split at a separator, the reading with the left part as title is noted left=artist, and the other left=title."""
    names = df.columns
    df = spread(df).withColumns({"_t": clean(F.col(title)), "_a": clean(F.col(artist))})
    df = df.withColumns({"_ct": clean_title(F.col("_t")), "_ca": clean_artist(F.col("_a"))})  # made once a row, whatever number of readings has them
    t, a, cleaned_title, cleaned_artist = (F.col(c) for c in ("_t", "_a", "_ct", "_ca"))
    one = lambda x, y, note: F.struct(clean(x).alias("cand_title"), clean(y).alias("cand_artist"), F.lit(note).alias("note"))
    readings = [one(cleaned_title, cleaned_artist, "current_cleaned"), one(t, cleaned_artist, "raw_title_cleaned_artist"), one(cleaned_title, a, "cleaned_title_raw_artist")]

    def both_ways(left: Column, right: Column, note: str, backwards: str, holds: Column) -> list[Column]:
        ok = holds & (left != "") & (right != "")
        out = []
        for x, y, n in ((right, left, note), (left, right, backwards)):
            out += [F.when(ok, one(clean_title(x), clean_artist(y), n)), F.when(ok, one(clean_title(x), y, f"{n}_artist_raw")), F.when(ok, one(x, clean_artist(y), f"{n}_title_raw"))]
        return out

    for s in SEPARATORS:
        left, right = clean(F.substring_index(t, s, 1)), clean(F.when(t.contains(s), F.substring(t, F.instr(t, s) + len(s), F.length(t))).otherwise(""))
        readings += both_ways(right, left, f"split:{s}:left=artist", f"split:{s}:left=title", t.contains(s))
    parts = F.split(t, rf"(?iu)\s+(?:feat\.?|featuring|ft\.?)(?:\s+|(?<=\.)(?={LETTER})|(?<!\.)(?!{LETTER}))", 2)
    guest = clean(F.coalesce(F.get(parts, F.lit(1)), F.lit("")))
    readings += both_ways(guest, clean(F.get(parts, F.lit(0))), "feat_split", "feat_split_reversed", F.size(parts) == 2)
    readings.append(F.when(cleaned_title != t, one(cleaned_title, cleaned_artist, "title_noise_stripped")))
    named = F.filter(F.array_distinct(F.array_compact(F.array(*readings))), lambda x: x["cand_title"] != "")
    return df.select(*names, F.posexplode(named).alias("position", "_c")).select(*names, "position", "_c.*")


def cleanup_actions(df: DataFrame, row_id: str, title: str, artist: str, results: DataFrame, result_key: str) -> DataFrame:
    """For each row what to do: replace with the best provider result, or why not.

    results (result_key, result_title, result_artist) are staged lookups by the candidate's normalised title."""
    rows = df.withColumn("_suspicious", looks_suspicious(F.col(title), F.col(artist)))
    candidates = title_candidates(rows.where("_suspicious").select(row_id, title, artist), title, artist)
    keyed = candidates.withColumn("_key", match_text(F.col("cand_title")))
    joined = keyed.join(results, F.col("_key") == F.col(result_key))
    scored = joined.withColumn("score", match_score(F.col("cand_title"), F.col("cand_artist"), F.col("result_title"), F.col("result_artist")))
    best = first_per_key(scored, [row_id], [F.desc("score"), "position", "result_title", "result_artist"]).select(F.col(row_id).alias("_row"), "score", "result_title", "result_artist")
    out = rows.join(best, F.col(row_id) == F.col("_row"), "left")
    action = F.when(~F.col("_suspicious"), "skip_not_suspicious").when(F.col("score").isNull(), "skip_no_result").when(F.col("score") < ACCEPTED, "skip_low_score").otherwise("replace")
    return out.withColumn("action", action).drop("_suspicious", "_row")


def relation_pairs(payloads: DataFrame, row_id: str, title: str, artist: str, payload: str) -> DataFrame:
    """(original, cover) pairs of JSON payloads with lists of covers and originals, both directions."""
    person = "array<struct<title:string,artist:string,url:string>>"
    p = payloads.withColumn("p", F.from_json(F.col(payload), f"covers {person}, originals {person}"))
    covers = p.select(row_id, F.inline("p.covers"), F.col(title).alias("_t"), F.col(artist).alias("_a"))
    originals = p.select(row_id, F.inline("p.originals"), F.col(title).alias("_t"), F.col(artist).alias("_a"))
    one = lambda df, ot, oa, ct, ca: df.select(row_id, F.col(ot).alias("original_title"), F.col(oa).alias("original_artist"), F.col(ct).alias("cover_title"), F.col(ca).alias("cover_artist"), "url")
    return one(covers, "_t", "_a", "title", "artist").unionByName(one(originals, "title", "artist", "_t", "_a"))


def work_covers(recordings: DataFrame, work: str, artist: str, original: Column) -> DataFrame:
    """Recordings of a work by others than its original's artist."""
    first = recordings.where(original).groupBy(F.col(work).alias("_work")).agg(F.min(artist).alias("original_artist"))
    return recordings.join(first, F.col(work) == F.col("_work")).where(F.lower(artist) != F.lower("original_artist")).drop("_work")


def original_choice(performances: DataFrame, key: str, exact: Column, is_original: Column, position: str) -> DataFrame:
    """Of each key's exact performances the original, else the first."""
    return first_per_key(performances.where(exact), [key], [F.when(is_original, 0).otherwise(1), position])


def cover_run(selected: DataFrame, key: str, candidates: DataFrame, checks: DataFrame, sources: list[str], source: str, stamp: str, sequence: str) -> DataFrame:
    """Candidates of the selected keys, each with its key's latest check by source."""
    latest = checks.groupBy(F.col(key).alias("_key")).pivot(source, sources).agg(F.max_by(stamp, F.struct(stamp, sequence)))
    latest = latest.select("_key", *[F.col(s).alias(f"checked_{s}") for s in sources])
    wanted = candidates.join(selected.select(F.col(key)).distinct(), key, "left_semi")
    return wanted.join(latest, F.col(key) == F.col("_key"), "left").drop("_key")


def suggestions(df: DataFrame, row_id: str, tags: Column, categories: dict[str, tuple[list[str], int]]) -> DataFrame:
    """(row, category, tag): a few tags of each category."""
    of = lambda category: lambda tag: F.struct(F.lit(category).alias("category"), tag.alias("tag"))
    lists = [F.transform(tags_in(tags, words, most), of(c)) for c, (words, most) in categories.items()]
    return df.select(row_id, F.inline(F.concat(*lists)))


#: What a performance has where nothing is known of it, and the searches of a record: site -> start, what is preferred.
PERFORMANCE = {
    "tuning": "Standard", "capo": "None", "guitar_difficulty": "Intermediate", "bass_difficulty": "Novice", "drum_difficulty": "Novice", "vocal_range": "", "instrumentation": "Vocals, Guitar, Bass, Drums",
    "arrangement_notes": "Standard rock/pop arrangement", "source_url": "Generative Suggestion", "confidence": "Low", "notes": "Auto-filled standard defaults; requires manual tuning verification.",
}
SEARCHES = {
    "Ultimate Guitar": ("https://www.ultimate-guitar.com/search.php?search_type=title&value=", "Prefer Official Tab, fallback to highest rated."),
    "SecondHandSongs": ("https://secondhandsongs.com/search?search_text=", "Requires exact title/artist match."),
    "WhoSampled": ("https://www.whosampled.com/search/?q=", "Requires exact title/artist match."),
}


def mood_suggestions(df: DataFrame, row_id: str, tags: Column, source_url: Column, categories: dict[str, tuple[list[str], int]]) -> DataFrame:
    """A row for each record: its tags of each category (suggested_<category>), where they are from, and how sure they are."""
    some = F.size(F.coalesce(tags, F.array().cast("array<string>"))) > 0
    columns = [F.array_join(tags_in(F.coalesce(tags, F.array().cast("array<string>")), words, most), ", ").alias(f"suggested_{c}") for c, (words, most) in categories.items()]
    return df.select(row_id, *columns, text_of(source_url).alias("source_url"), F.when(some, "Medium").otherwise("Low").alias("confidence"), F.when(some, "Extracted from tags").otherwise("No tags found").alias("notes"))


def performance_suggestions(df: DataFrame, row_id: str, bpm: Column, key: Column, defaults: dict[str, str] = PERFORMANCE) -> DataFrame:
    """A row for each record: its tempo and key as they are, and defaults."""
    return df.select(row_id, text_of(bpm).alias("bpm"), text_of(key).alias("musical_key"), *[F.lit(v).alias(k) for k, v in defaults.items()])


def search_suggestions(df: DataFrame, row_id: str, title: Column, artist: Column, searches: dict[str, tuple[str, str]] = SEARCHES) -> DataFrame:
    """A row for each record and site: an unverified search for its artist and title."""
    columns = lambda site, start, notes: F.struct(
        F.lit(site).alias("site"), F.lit("").alias("verified_url"), search_url(start, artist, title).alias("search_url"), F.lit("Search Query").alias("match_type"), F.lit("Low").alias("confidence"), F.lit(notes).alias("notes"),
    )
    return df.select(row_id, F.inline(F.array(*[columns(s, *v) for s, v in searches.items()])))


def takeout_export(seen: DataFrame, key: str, metadata: DataFrame, title: str, artist: str) -> tuple[DataFrame, DataFrame]:
    """(sightings with their metadata and lookup status, distinct songs of those found)."""
    joined = seen.join(metadata.withColumnRenamed(key, "_id"), F.col(key) == F.col("_id"), "left")
    joined = joined.withColumn("lookup_status", F.when(F.col("_id").isNull(), "not_found").otherwise("found")).drop("_id")
    found = joined.where("lookup_status = 'found'").withColumns({"_t": match_text(F.col(title)), "_a": match_text(F.col(artist))})
    return joined, first_per_key(found, ["_t", "_a"], [key]).select(key, title, artist)


def with_context(df: DataFrame, lookups: list[tuple[DataFrame, dict[str, str], dict[str, str]]]) -> DataFrame:
    """df with columns of several lookup tables (one row a key): (table, df column -> its key, its column -> new name)."""
    for k, (other, keys, columns) in enumerate(lookups):
        side = other.select(*[F.col(b).alias(f"_k{k}_{b}") for b in keys.values()], *[F.col(c).alias(n) for c, n in columns.items()])
        on = reduce(lambda a, b: a & b, [F.col(a) == F.col(f"_k{k}_{b}") for a, b in keys.items()])
        df = df.join(side, on, "left").drop(*[f"_k{k}_{b}" for b in keys.values()])
    return df


def repaired_rows(df: DataFrame, fields: dict[str, str], providers: tuple[dict[str, str], dict[str, str]]) -> DataFrame:
    """df with fixed_<field>, two providers' confidences, their agreement, the decision and its source.

    fields: title, artist and album -> columns of df; providers: the same -> columns of their staged results."""
    rows = df.withColumns({f"fixed_{f}": repaired(F.col(c)) for f, c in fields.items()})
    ratio = lambda a, b: indel_ratio(match_text(a), match_text(b))
    confidence = [text_confidence(*[ratio(F.col(f"fixed_{f}"), F.col(p[f])) for f in ("title", "artist", "album")]) for p in providers]
    agree = text_confidence(*[ratio(F.col(providers[0][f]), F.col(providers[1][f])) for f in ("title", "artist", "album")])
    rows = rows.withColumns({"confidence_first": confidence[0], "confidence_second": confidence[1], "agreement": agree})
    decision = repair_decision(F.col("fixed_title"), F.col("confidence_first"), F.col("confidence_second"), F.col("agreement"))
    source = F.when(F.col("decision") == "accepted_both_agree", "both").when(F.col("decision") == "accepted_first", "first").when(F.col("decision") == "accepted_second", "second").otherwise("")
    return rows.withColumn("decision", decision).withColumn("source", source)


def song_positions(df: DataFrame, by: str, order: list[str]) -> DataFrame:
    """df with each row's place in its group."""
    return df.withColumn("position", F.row_number().over(Window.partitionBy(by).orderBy(*order)))
