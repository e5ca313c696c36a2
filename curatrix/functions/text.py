"""Text normalisation as Column functions.

Everything is a native expression but Unicode normal forms, percent-decoding and byte repair, which Spark lacks: those
are Arrow UDFs, which get null for the rows that do not need them (`only_where`) and skip these. Blank and null are the same throughout: "".
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Typographic characters and what displays in their place.
SPACES = "               　"
APOSTROPHES = "‘’‚‛′ʼʹ´"
QUOTES = "“”„‟″"
DASHES = "‐‑‒–—―−⁃"
TILDES = "∼～"
#: Words that mark a title as a video's or an edition's.
NOISE_WORDS = ("official", "video", "lyric", "tutorial", "channel", "hd", "4k", "remaster", "remastered", "audio", "preview", "playlist", "topic")
ARTIST_NOISE = ("actual life", "junos 365 sessions", "disney channel animation", "volume ", "official", "topic")
EDITIONS = "radio edit|edit|live|remaster(?:ed)?|remix|acoustic|instrumental|mono|stereo"
MOJIBAKE = ("Ã", "Â", "ðŸ", "ï¿½")
#: Patterns of the keys and of the cleaning of titles and artists, in the order they apply.
GUEST = r"\b(feat|featuring|ft)\.?\b.*$"
ANY_BRACKETS = r"\([^)]*\)|\[[^\]]*\]"
FUZZY_STEPS = ((GUEST, ""), (r"\[[^\]]*\]", " "), (rf"\([^)]*(?:{'|'.join(NOISE_WORDS)})[^)]*\)", " "), (r"\(([^)]*)\)", " $1 "), (r"\b(the|a|an)\b", " "), ("[^a-z0-9]+", " "))
CORE_STEPS = ((rf"\s*[-–—]\s*(?:{EDITIONS})\b.*$", ""), (rf"\s*\(([^)]*(?:{EDITIONS})[^)]*)\)", " "), (rf"\s*\[[^\]]*(?:{EDITIONS})[^\]]*\]", " "), ("&", " and "))
#: What a word is made of. \b also takes marks for letters and leaves out numbers like ², and (?i) alone matches no letters but ASCII.
LETTER = r"[\p{L}\p{N}_]"
TITLE_WORDS = "official|video|lyric|channel|topic|hd|4k|audio|preview"
TITLE_STEPS = ((rf"(?iu)\s*\[[^\]]*(?:{TITLE_WORDS})[^\]]*\]", ""), (rf"(?iu)\s*\(([^)]*(?:{TITLE_WORDS})[^)]*)\)", ""), (rf"(?iu)\s*[-–—]\s*(?:official|video|lyric|audio)(?!{LETTER}).*$", ""), (r"(?iu)\s*\|\s*(?:official|video|lyric|audio|channel|topic).*$", ""), (r"\s+\#\S+.*$", ""))
ARTIST_STEPS = ((r"\s*\|\s*.*$", ""), (r"(?iu)\s*\(.*?(?:official|video|channel|topic|music|remix).*$", ""), (r"(?iu)\s+(?:actual life|junos 365 sessions|disney channel animation|volume \p{Nd}+|official|topic).*$", ""))
LIST_STEPS = ((r"[\p{So}\x{1F000}-\x{1FAFF}\x{FE0F}]", ""), (r"(?i)^(?:\d{1,3}|[IVXLCDM]+)\s*\.\s*", ""), (r"^[-*|_~]\s*", ""), (r"(?i)^Songs Like\s+", ""))
#: White space: what Unicode says, and the four separators U+001C to U+001F.
BLANKS = r"\s\x{1C}-\x{1F}"


def text_of(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def clean(c: Column) -> Column:
    """Runs of any Unicode space become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(text_of(c), rf"(?U)[{BLANKS}]+", " "))


def is_blank(c: Column) -> Column:
    return clean(c) == ""


def nonblank(c: Column) -> Column:
    return ~is_blank(c)


def or_null(c: Column) -> Column:
    """The cleaned value, null if blank."""
    return F.nullif(clean(c), F.lit(""))


def first_nonblank(*columns: Column) -> Column:
    """The first of the columns that is not blank, cleaned; "" if all are."""
    return F.coalesce(*[or_null(c) for c in columns], F.lit(""))


def replaced(c: Column, *steps: tuple[str, str]) -> Column:
    """Regular-expression replacements, one after the other."""
    return reduce(lambda x, s: F.regexp_replace(x, s[0], s[1]), steps, c)


def only_where(condition: Column, change: Callable[[Column], Column], plain: Column) -> Column:
    """plain, changed by a UDF where the condition holds. The UDF gets null for all other rows."""
    return F.coalesce(change(F.when(condition, plain)), plain)


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f reads it. Spark then also cuts the code of such a projection into small methods: in
    one method a few functions of this kind are too long for the JVM to compile, and each row is interpreted. f can't hold a UDF."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


#: How many values of a batch are Python objects at a time.
SLICE = 256


def changed(values: pa.Array, change: Callable[[str], str], blank: str | None = None) -> pa.Array:
    """The values that are there, changed, and blank for null, a slice after the other: long texts are Python objects only for a while."""
    pieces = [pa.array([blank if v is None else change(v) for v in values.slice(k, SLICE).to_pylist()], pa.string()) for k in range(0, len(values), SLICE)]
    return pa.concat_arrays(pieces) if pieces else pa.array([], pa.string())


@F.arrow_udf(T.StringType())
def _percent_decoded(values: pa.Array) -> pa.Array:
    return changed(values, unquote)


@F.arrow_udf(T.StringType())
def _composed(values: pa.Array) -> pa.Array:
    return changed(values, lambda v: unicodedata.normalize("NFKC", v))


@F.arrow_udf(T.StringType())
def _decomposed(values: pa.Array) -> pa.Array:
    return changed(values, lambda v: unicodedata.normalize("NFKD", v))


@F.arrow_udf(T.StringType())
def _latin1_read_as_utf8(values: pa.Array) -> pa.Array:
    return changed(values, lambda v: v.encode("latin-1", "ignore").decode("utf-8", "ignore"))


@F.arrow_udf(T.StringType())
def _searched(values: pa.Array) -> pa.Array:
    return changed(values, searched)


def has_non_ascii(c: Column) -> Column:
    return c.rlike(r"[^\x00-\x7F]")


def display_text(c: Column) -> Column:
    """Text as it should show: percent escapes decoded (but in urls), typographic characters simplified, compatibility forms composed, invisible characters dropped, spaces collapsed."""
    t = text_of(c)
    escaped = t.rlike(r"%[0-9A-Fa-f]{2}") & ~t.rlike(r"(?i)^[a-z][a-z0-9+.-]*://")
    t = only_where(escaped, _percent_decoded, t)
    t = F.translate(t, SPACES + APOSTROPHES + QUOTES + DASHES + TILDES, " " * len(SPACES) + "'" * len(APOSTROPHES) + '"' * len(QUOTES) + "-" * len(DASHES) + "~" * len(TILDES))
    t = only_where(has_non_ascii(t), _composed, t)
    return clean(F.regexp_replace(t, r"[\p{Cf}\p{Cc}&&[^\t\n\r]]", ""))


def match_text(c: Column) -> Column:
    """Text as it compares: decomposed, without marks and symbols but . , and -, spaces collapsed, lower case. Other than ASCII text goes by Python's Unicode tables (`searched`), which may know more letters than the JVM's."""
    t = text_of(c)
    return F.coalesce(_searched(F.when(has_non_ascii(t), t)), F.lower(clean(F.regexp_replace(t, rf"[^A-Za-z0-9_{BLANKS}.,-]", ""))))


def match_artist(c: Column) -> Column:
    return F.regexp_replace(match_text(c), "^the ", "")


def search_text(c: Column) -> Column:
    return match_text(display_text(c))


def ascii_folded(c: Column) -> Column:
    """Decomposed, with everything outside ASCII dropped."""
    return F.regexp_replace(only_where(has_non_ascii(c), _decomposed, c), r"[^\x00-\x7F]", "")


def spaced_key(c: Column, *, apostrophes: bool = False, fold: bool = False, guests: bool = False, brackets: bool = False, article: bool = False) -> Column:
    """Lower-case letters and digits separated by single spaces, & as and; the options drop apostrophes, accents, guest artists, bracketed parts and the word the."""
    t = F.replace(F.lower(clean(c)), F.lit("&"), F.lit(" and "))
    t = F.regexp_replace(t, "[’‘`']", "") if apostrophes else t
    t = ascii_folded(t) if fold else t
    t = F.regexp_replace(t, GUEST, "") if guests else t
    t = F.regexp_replace(t, ANY_BRACKETS, " ") if brackets else t
    t = F.regexp_replace(t, r"\bthe\b", " ") if article else t
    return F.trim(F.regexp_replace(t, r"[^a-z0-9]+", " "))


def song_key(c: Column) -> Column:
    """The fullest key: one song under all its spellings."""
    return spaced_key(c, apostrophes=True, fold=True, guests=True, brackets=True, article=True)


def ascii_song_key(c: Column) -> Column:
    """song_key of text that is ASCII alone, without a UDF."""
    return once(c, lambda t: spaced_key(t, apostrophes=True, guests=True, brackets=True, article=True))


def import_key(c: Column) -> Column:
    """song_key for plain text: apostrophes and accents separate words."""
    return spaced_key(c, guests=True, brackets=True, article=True)


def merge_key(c: Column) -> Column:
    """song_key that keeps guests and brackets, so that versions stay apart."""
    return spaced_key(c, apostrophes=True, fold=True, article=True)


def takeout_key(c: Column) -> Column:
    return spaced_key(c, guests=True, brackets=True)


def compact_key(c: Column) -> Column:
    """Lower-case letters and digits alone."""
    return F.regexp_replace(F.lower(text_of(c)), "[^a-z0-9]+", "")


def compact_artist(c: Column) -> Column:
    return F.regexp_replace(compact_key(c), "^the(?=.)", "")


def fuzzy_key(c: Column) -> Column:
    """For similarity: brackets with noise words dropped, other brackets opened, articles dropped."""
    t = F.replace(F.replace(F.lower(clean(c)), F.lit("&"), F.lit(" and ")), F.lit("’"), F.lit("'"))
    return F.trim(replaced(t, *FUZZY_STEPS))


def title_core(c: Column) -> Column:
    """A title without edition suffixes."""
    return F.trim(F.regexp_replace(replaced(F.lower(clean(c)), *CORE_STEPS), "[^a-z0-9]+", " "))


def clean_title(c: Column) -> Column:
    """A title without what video sites add."""
    return clean(replaced(clean(c), *TITLE_STEPS))


def clean_artist(c: Column) -> Column:
    """An artist without what video sites add."""
    return clean(replaced(clean(c), *ARTIST_STEPS))


def clean_list_artist(c: Column) -> Column:
    """An artist without the numbering, bullet or emoji of a list."""
    return clean(replaced(clean(c), *LIST_STEPS))


def artist_without_title(artist: Column, title: Column) -> Column:
    """An artist without the title that was joined to its end."""
    a, t = clean(artist), clean(title)
    tail = (t != "") & (F.length(a) > F.length(t)) & F.endswith(F.lower(a), F.lower(t))
    return F.when(tail, F.regexp_replace(F.substring(a, F.lit(1), F.length(a) - F.length(t)), r"[\s\-–—:|,]+$", "")).otherwise(a)


def lead_artist(c: Column) -> Column:
    return F.trim(F.get(F.split(clean(c), r"(?i)\s+(?:feat\.?|ft\.?|featuring)\s+"), F.lit(0)))


def repaired(c: Column) -> Column:
    """UTF-8 that was once read as Latin-1, read again; text without such marks is left alone."""
    return only_where(looks_mojibake(c), _latin1_read_as_utf8, text_of(c))


def looks_mojibake(c: Column) -> Column:
    return text_of(c).rlike("|".join(MOJIBAKE))


def looks_video_title(c: Column) -> Column:
    return F.lower(text_of(c)).rlike(r"\||cover|acoustic|feat\.|/|-")


def looks_interesting(*columns: Column) -> Column:
    """Text worth a closer look: non-ASCII, several artists, or edition words."""
    joined = F.concat_ws(" ", *[text_of(c) for c in columns])
    return joined.rlike(r"[^\x00-\x7F]") | joined.rlike(r"(?i)\bfeat\b|\bft\.|\bvs\.?\b|&|;|/|\bremix\b|\bcover\b|\blive\b")


def looks_suspicious(title: Column, artist: Column) -> Column:
    """A row whose cleaning would change it, or that has noise words."""
    t, a = clean(title), clean(artist)
    words = lambda c, xs: F.lower(c).rlike("|".join(xs))
    return (clean_title(t) != t) | (clean_artist(a) != a) | t.contains(" - ") | t.contains(" | ") | t.rlike(r"(?i)\b(feat\.?|featuring|ft\.?)\b") | words(t, NOISE_WORDS) | words(a, ARTIST_NOISE)


def is_track_id(c: Column) -> Column:
    return text_of(c).rlike(r"^[A-Za-z0-9]{22}\z")


def register(spark: SparkSession) -> None:
    """The normalisers as SQL functions."""

    @F.arrow_udf(T.StringType())
    def display(values: pa.Array) -> pa.Array:
        return changed(values, shown, "")

    @F.arrow_udf(T.StringType())
    def search(values: pa.Array) -> pa.Array:
        return changed(values, lambda v: searched(shown(v)), "")

    spark.udf.register("normalize_display_text", display)
    spark.udf.register("normalize_search_text", search)


def shown(value: str | None) -> str:
    """display_text of one value."""
    import re

    if value is None:
        return ""
    if re.search(r"%[0-9A-Fa-f]{2}", value) and not re.match(r"(?i)[a-z][a-z0-9+.-]*://", value):
        value = unquote(value)
    kinds = {**dict.fromkeys(SPACES, " "), **dict.fromkeys(APOSTROPHES, "'"), **dict.fromkeys(QUOTES, '"'), **dict.fromkeys(DASHES, "-"), **dict.fromkeys(TILDES, "~")}
    value = unicodedata.normalize("NFKC", "".join(kinds.get(x, x) for x in value))
    return " ".join(value.translate(_VISIBLE).split())


def searched(value: str) -> str:
    """match_text of one value."""
    plain = unicodedata.normalize("NFKD", value)
    return " ".join(plain.translate(_SEARCHED).split()).lower()


class Kept(dict):
    """For str.translate: drops the characters that a test refuses, which is asked once for each."""

    def __init__(self, test: Callable[[str], bool]):
        super().__init__()
        self.test = test

    def __missing__(self, code: int) -> int | None:
        self[code] = code if self.test(chr(code)) else None
        return self[code]


_VISIBLE = Kept(lambda x: x in "\t\n\r" or unicodedata.category(x) not in ("Cf", "Cc"))
_SEARCHED = Kept(lambda x: x.isspace() or x in "_.,-" or unicodedata.category(x)[0] in "LN")
