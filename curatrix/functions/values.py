"""Durations, years, lists, hashes, scores and JSON as Column functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean, is_blank, match_artist, match_text, nonblank, or_null, search_text, song_key, text_of

#: What names a version in a title or an album.
VERSION_PATTERNS = [r"\blive\b", r"\bremaster(?:ed)?\b", r"\bremix\b", r"\bradio edit\b", r"\bsingle version\b", r"\balbum version\b", r"\bextended\b", r"\bacoustic\b", r"\binstrumental\b", r"\bdemo\b", r"\bcover\b", r"\bkaraoke\b", r"\b8d audio\b"]
NO_VERSION = "studio/original unless noted"
#: Keys and their relatives. The list is not symmetric.
RELATIVE_KEYS = {
    "C": "Am", "Am": "C", "C#": "A#m", "A#m": "C#", "Db": "Bbm", "Bbm": "Db", "D": "Bm", "Bm": "D", "D#": "Cm", "Cm": "D#", "Eb": "Cm",
    "E": "C#m", "C#m": "E", "F": "Dm", "Dm": "F", "F#": "D#m", "D#m": "F#", "Gb": "Ebm", "Ebm": "Gb", "G": "Em", "Em": "G", "G#": "Fm", "Fm": "G#",
    "Ab": "Fm", "A": "F#m", "F#m": "A", "A#": "Gm", "Gm": "A#", "Bb": "Gm", "B": "G#m", "G#m": "B",
}
REMASTERED = r"\bremaster(?:ed)?\b"
LIVE = r"\blive\b|\bunplugged\b|\bconcert\b|\bsession\b"
EXTENDED = r"\bextended\b|\bep\b|\b7[ -]?inch\b|\b7\"|\b7''|\bsingle version\b|\bsingle edit\b|\bradio edit\b"


# --- durations, numbers, years

def duration_seconds(c: Column) -> Column:
    """m:ss or h:mm:ss as seconds; null for anything else."""
    t = clean(c)
    part = lambda k: F.get(F.split(t, ":"), F.lit(k)).try_cast("long")
    end = lambda k: F.substring_index(t, ":", k).try_cast("long")
    return F.when(t.rlike(r"^\d+:\d+\z"), end(1) * 60 + end(-1)).when(t.rlike(r"^\d+:\d+:\d+\z"), part(0) * 3600 + part(1) * 60 + part(2))


def clock(minutes: Column, seconds: Column) -> Column:
    """m:ss of whole numbers; null if one is null."""
    s = seconds.cast("string")
    return F.concat(minutes.cast("string"), F.lit(":"), F.when(seconds.between(0, 9), F.concat(F.lit("0"), s)).otherwise(s))


def duration_from_ms(ms: Column, *, floor: bool = False) -> Column:
    """Milliseconds as m:ss; half-even rounding unless floor; blank if no number."""
    n = ms.try_cast("double")
    s = (F.floor(n / 1000) if floor else F.bround(n / 1000)).cast("long")
    return F.when(s.isNull(), "").otherwise(clock(F.floor(s / 60), s % 60))


def compact_duration(c: Column, key=song_key) -> Column:
    """m:ss without leading zeros; other text as its song key. key: ascii_song_key where c is known to be ASCII."""
    t = clean(c)
    timed = t.rlike(r"^\d+:\d{2}\z")
    return F.when(timed, F.concat(F.substring_index(t, ":", 1).try_cast("bigint").cast("string"), F.lit(":"), F.substring_index(t, ":", -1))).otherwise(key(F.when(~timed, t)))


def numeric_string(c: Column) -> Column:
    """A number without a needless fraction; null if it is none."""
    n = or_null(c).try_cast("double")
    return F.when(n == F.floor(n), n.cast("decimal(38,0)").cast("string")).otherwise(n.cast("string"))


def year_in(c: Column) -> Column:
    """The first year from 1900 to 2099 anywhere in the text."""
    return F.regexp_extract(text_of(c), r"\b(19\d{2}|20\d{2})\b", 1).try_cast("int")


def year_prefix(c: Column) -> Column:
    return F.regexp_extract(clean(c), r"^(\d{4})", 1).try_cast("int")


def best_year(year: Column, release: Column, upload: Column) -> Column:
    return F.coalesce(year_prefix(year), year_prefix(release), year_prefix(upload))


def comparable_value(field: Column, value: Column, kinds: dict[str, str]) -> Column:
    """A value as its field compares: kinds maps fields to year, duration, number, flag or key; others compare as cleaned text."""
    v = clean(value)
    how = {"year": F.coalesce(year_in(v).cast("string"), v), "duration": F.coalesce(duration_seconds(v).cast("string"), v), "number": F.coalesce(numeric_string(v), v), "flag": F.lower(v), "key": song_key(v)}
    return reduce(lambda c, k: F.when(field.isin(*[f for f, x in kinds.items() if x == k]), how[k]).otherwise(c), [k for k in how if k in kinds.values()], v)


# --- lists

def listed(c: Column, separators: str = ";", *, lower: bool = False) -> Column:
    """A delimited cell as an array of trimmed, nonblank values."""
    parts = F.filter(F.transform(F.split(text_of(c), f"[{separators}]"), lambda x: F.trim(x)), lambda x: x != "")
    return F.transform(parts, lambda x: F.lower(x)) if lower else parts


def distinct_ignoring_case(values: Column) -> Column:
    """The nonblank values in order, each spelling's first only."""
    return F.aggregate(
        F.filter(F.transform(values, lambda x: clean(x)), lambda x: x != ""), F.array().cast("array<string>"),
        lambda seen, x: F.when(F.exists(seen, lambda y: F.lower(y) == F.lower(x)), seen).otherwise(F.array_append(seen, x)),
    )


def semicolon_join(values: Column) -> Column:
    return F.array_join(distinct_ignoring_case(values), "; ")


def added_to_list(cell: Column, more: Column, separators: str = ";") -> Column:
    """A delimited cell with the values of another that it lacks."""
    return F.array_join(F.array_distinct(F.concat(listed(cell, separators), listed(more, separators))), "; ")


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all values; 0 where either is empty."""
    union = F.size(F.array_union(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def tags_in(tags: Column, words: list[str], most: int) -> Column:
    """The first few tags that belong to a category."""
    return F.slice(F.filter(tags, lambda x: F.lower(x).isin(*words)), 1, most)


def completeness(columns: list[Column], bonuses: list[tuple[Column, int]] | None = None) -> Column:
    """How many columns are filled, and points for conditions that hold."""
    points = [F.when(nonblank(c), 1).otherwise(0) for c in columns] + [F.when(F.coalesce(c, F.lit(False)), n).otherwise(0) for c, n in bonuses or []]
    return reduce(lambda a, b: a + b, points)


def infer_version(title: Column, album: Column) -> Column:
    """The version words found in title and album."""
    hay = F.lower(F.concat_ws(" ", text_of(title), text_of(album)))
    found = F.filter(F.array(*[F.regexp_extract(hay, f"({p})", 1) for p in VERSION_PATTERNS]), lambda x: x != "")
    return F.when(F.size(found) > 0, F.array_join(F.array_distinct(found), "; ")).otherwise(F.lit(NO_VERSION))


# --- identity

def stable_id(title: Column, artist: Column, version: Column | None = None) -> Column:
    """A hash of what a row means: its title, artist and (if not blank) version."""
    parts = F.concat_ws("|", match_text(title), match_artist(artist), F.nullif(match_text(version), F.lit("")) if version is not None else F.lit(None).cast("string"))
    return F.sha2(parts, 256)


def short_id(prefix: str, *parts: Column, digits: int = 12, separator: str = "␟") -> Column:
    """A prefix and the first digits of a hash of the parts, upper case."""
    return F.concat(F.lit(prefix), F.upper(F.substring(F.sha1(F.concat_ws(separator, *[text_of(p) for p in parts])), 1, digits)))


def seed_id(title: Column, artist: Column, album: Column) -> Column:
    return short_id("SEED-", search_text(title), search_text(artist), search_text(album), digits=16, separator="|")


def hashed_id(*parts: Column) -> Column:
    return F.sha1(F.concat_ws("|", *[text_of(p) for p in parts]))


def song_signature(title: Column, artist: Column, album: Column, duration: Column) -> Column:
    return F.concat_ws("|||", song_key(title), song_key(artist), song_key(album), compact_duration(duration))


def match_keys(titles: list[Column], artists: list[Column], key=song_key) -> Column:
    """All distinct title and artist keys of a row, where neither is blank."""
    pairs = [F.when((key(t) != "") & (key(a) != ""), F.concat_ws("|||", key(t), key(a))) for t in titles for a in artists]
    return F.array_distinct(F.array_compact(F.array(*pairs)))


def spacing_variants(c: Column) -> Column:
    """A key as it is, without spaces, without and, and without both."""
    k = song_key(c)
    short = F.trim(F.regexp_replace(F.regexp_replace(k, r"\band\b", " "), " +", " "))
    return F.filter(F.array_distinct(F.array(k, F.replace(k, F.lit(" "), F.lit("")), short, F.replace(short, F.lit(" "), F.lit("")))), lambda x: x != "")


# --- scores

def agreement(a: Column, b: Column, key=search_text) -> Column:
    """missing, exact, partial (one contains the other) or different."""
    x, y = key(a), key(b)
    return F.when((x == "") & (y == ""), "missing").when(x == y, "exact").when((x != "") & (y != "") & (x.contains(y) | y.contains(x)), "partial").otherwise("different")


def weighted(status: Column, weights: dict[str, int]) -> Column:
    """Whole-number points of a status, 0 if it has none."""
    return reduce(lambda c, k: F.when(status == k, weights[k]).otherwise(c), weights, F.lit(0))


def bpm_score(a: Column, b: Column) -> Column:
    """10 for equal tempos, falling to 0 at a difference of 15; 0 without a tempo."""
    gap = F.abs(a.cast("double") - b.cast("double"))
    return F.when((F.coalesce(a, F.lit(0)) != 0) & (F.coalesce(b, F.lit(0)) != 0) & (gap <= 15), 10.0 * (1.0 - gap / 15.0)).otherwise(F.lit(0.0))


def key_score(a: Column, b: Column) -> Column:
    """5 for the same key, 3 for a's relative."""
    relatives = F.create_map(*[F.lit(x) for pair in RELATIVE_KEYS.items() for x in pair])
    x, y = F.trim(text_of(a)), F.trim(text_of(b))
    return F.when((x == "") | (y == ""), 0.0).when(x == y, 5.0).when(F.coalesce(F.element_at(relatives, x) == y, F.lit(False)), 3.0).otherwise(0.0)


def edition_score(text: Column) -> Column:
    """Preference among editions: remasters before, live and extended ones after the rest."""
    t = F.lower(text_of(text))
    return F.when(t.rlike(REMASTERED), 4).otherwise(0) + F.when(t.rlike(LIVE), -8).otherwise(0) + F.when(t.rlike(EXTENDED), -3).otherwise(0)


def score_text(thousandths: Column) -> Column:
    """A score kept in thousandths as text with three decimals."""
    return F.format_string("%d.%03d", F.floor(thousandths / 1000), thousandths % 1000)


# --- JSON and notes

def json_value(c: Column, *path: str) -> Column:
    """A nested field as text; "" if it or the JSON is missing or bad."""
    return F.coalesce(F.get_json_object(c, "$." + ".".join(path)), F.lit(""))


def canonical_json(entries: Column) -> Column:
    """A map as JSON with sorted keys."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(entries))))


def value_of(names: dict[str, Column], which: Column) -> Column:
    """The value of the column that another column names."""
    return F.element_at(F.create_map(*[x for k, c in names.items() for x in (F.lit(k), text_of(c))]), which)


def filled_note(columns: dict[str, Column]) -> Column:
    """field=value of the filled columns."""
    return F.concat_ws("; ", *[F.when(nonblank(c), F.concat(F.lit(f"{k}="), clean(c))) for k, c in columns.items()])


def search_url(base: str, *parts: Column) -> Column:
    return F.concat(F.lit(base), F.url_encode(clean(F.concat_ws(" ", *[text_of(p) for p in parts]))))


def provenance(source: Column, labels: dict[str, str], default: str) -> Column:
    """A label by what the source's text contains, the first that fits."""
    t = F.lower(text_of(source))
    return reduce(lambda c, k: F.when(t.contains(k), labels[k]).otherwise(c), reversed(list(labels)), F.lit(default))


def validation_errors(required: dict[str, Column], ranges: dict[str, tuple[Column, int, int]]) -> Column:
    """What is wrong with a row: missing values, values that are no integer, and values out of range."""
    missing = [F.when(is_blank(c), F.lit(f"Missing required field: {k}")) for k, c in required.items()]
    checks = []
    for k, (c, low, high) in ranges.items():
        n = or_null(c).try_cast("int")
        checks.append(F.when(is_blank(c), F.lit(None).cast("string")).when(n.isNull(), F.lit(f"{k} must be an integer")).when(~n.between(low, high), F.lit(f"{k} must be between {low} and {high}")))
    return F.array_compact(F.array(*missing, *checks))


