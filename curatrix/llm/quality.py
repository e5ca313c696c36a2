"""Quality rules: repetition counts, and how far a document's character classes and common words diverge from its language.

Everything here is DataFrame functions. A document's two histograms (character classes; the common words of its
language, one by one, and all other words) are compared with the sums of the same histograms over all documents of that
language that pass the base rules, by Jensen-Shannon distance (base 2, so 0 to 1). A histogram is only judged where the document is
long enough for it to mean something. The common words are learned by grouped counts: of the words of letters that COMMON_SHARE of a
language's documents have at least, the N_COMMON that most of them have. Both kinds of references come from the table that is judged.

Defined results: a null or blank text has no words, fails the base rules and is not kept; a language that is null
or has less than LANGUAGE_SHARE of all rows counts as "other", all of these together; a language whose reference is
empty is not judged by distance. Repeated rows are judged one by one. Columns of the input whose names clash with
a result column are replaced by it; internal columns clash with none.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, let, once, stored, table, words_of

LANGUAGE_SHARE, COMMON_SHARE, N_COMMON = 0.01, 0.1, 16
OTHER = "other"
NO_SYMBOLS = r"[^#*$%&|<>]+"
#: A document with fewer words, or fewer visible characters, is not judged by distance.
MIN_WORDS, MIN_CHARS = 50, 200
#: The largest distances from the language's histograms that a kept document has.
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.27, 0.32
RESULTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "char_distance", "word_distance", "base_failed", "kept"]
CLASSES = ["letters", "capitals", "digits", "symbols", "marks", "spaces"]


def repeated_words(words: Column) -> Column:
    """How many words lie in 3-word windows that occur twice or more.

    Texts without an equal pair of windows end at the first comparison. In the others the repeated hashes are looked
    up where they are few, and windows are sorted by hash where they are many, so that no text costs more than its
    length times a logarithm.
    """

    def hashes(w: Column) -> Column:
        n = F.greatest(F.size(w) - 2, F.lit(0))
        return F.transform(F.arrays_zip(F.slice(w, 1, n), F.slice(w, 2, n), F.slice(w, 3, n)), lambda x: F.xxhash64(x))

    def by_lookup(h: Column, twice: Column) -> Column:
        return F.filter(F.transform(h, lambda x, i: F.when(F.array_contains(twice, x), i).otherwise(-1)), lambda i: i >= 0)

    def by_sorting(h: Column) -> Column:
        def equal(s: Column) -> Column:
            same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
            return F.sort_array(F.transform(F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]))

        return let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), equal)

    def starts(h: Column) -> Column:
        twice = let(F.sort_array(h), lambda s: F.array_distinct(F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1) == x, F.lit(False)))))
        return let(twice, lambda t: F.when(F.size(t) <= 32, by_lookup(h, t)).otherwise(by_sorting(h)))

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x)

    return let(hashes(words), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(starts(h), covered))).cast("long")


def common_words(docs: DataFrame, text: str, lang: str) -> dict[str, list[str]]:
    """The languages, and "other", with their common words."""
    sizes = stored(docs.groupBy(F.col(lang).alias("_lang")).agg(F.count("*").alias("_n")))
    rows = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    named = {r["_lang"]: r["_n"] for r in sizes.where(F.col("_lang").isNotNull() & (F.col("_n") >= LANGUAGE_SHARE * rows)).collect()}  # 1 / LANGUAGE_SHARE at most
    of = lang_key(F.col(lang), sorted(named))
    words = docs.select(of.alias("_lang"), F.explode(F.array_distinct(words_of(F.col(text)))).alias("_word"))
    least = F.lit(rows - sum(named.values()))
    for k, n in named.items():
        least = F.when(F.col("_lang") == k, n).otherwise(least)
    often = words.groupBy("_lang", "_word").agg(F.count("*").alias("_n")).where((F.col("_n") >= COMMON_SHARE * least) & F.col("_word").rlike(r"^\p{L}+\z"))
    found: dict[str, list[tuple[int, str]]] = {k: [] for k in [*named, OTHER]}
    for r in often.select("_lang", "_word", "_n").collect():  # of each language at most a text's mean number of distinct words / COMMON_SHARE
        found[r["_lang"]].append((-r["_n"], r["_word"]))
    return {k: [w for _, w in sorted(v)[:N_COMMON]] for k, v in sorted(found.items())}


def lang_key(lang: Column, known: list[str]) -> Column:
    return F.when(lang.isin(known), lang).otherwise(F.lit(OTHER)) if known else F.lit(OTHER)


def common_counts(words: Column, lang: Column, common: dict[str, list[str]]) -> Column:
    """How often each common word of the language occurs, and last how often all other words do."""
    lists = F.lit(None)
    for k, values in common.items():
        lists = F.when(lang == k, F.array(*[F.lit(v) for v in values]).cast("array<string>")).otherwise(lists)
    known = F.filter(words, lambda w: w.isin(sorted({v for values in common.values() for v in values})))
    places = let(lists, lambda x: F.transform(known, lambda w: F.coalesce(F.array_position(x, w), F.lit(0).cast("long"))))
    count = lambda p, k: (F.size(p) - F.size(F.array_remove(p, F.lit(k).cast("long")))).cast("long")
    counts = let(places, lambda p: F.array(*[count(p, k) for k in range(1, N_COMMON + 1)]))
    return let(counts, lambda c: F.array_append(c, F.size(words) - F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)))


def measured(docs: DataFrame, text: str, lang: str, common: dict[str, list[str]]) -> DataFrame:
    """docs with its counts: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the two histograms."""
    t = F.coalesce(F.col(text), F.lit(""))
    words, size = F.col("_words"), F.char_length
    rows = once(docs, {"_lang": lang_key(F.col(lang), [k for k in common if k != OTHER]), "_words": words_of(F.col(text)), "_rest": F.regexp_replace(t, r"[\p{Ll}\x20\x09-\x0D]+", "")})
    lines = F.filter(F.split(t, "\n"), lambda x: F.trim(F.lit(SPACES), x) != "")
    rest = F.col("_rest")
    rows = once(rows, {
        "n_words": F.size(words).cast("long"), "_chars": size(t).cast("long"), "word_chars": size(F.array_join(words, "")).cast("long"), "n_symbols": size(F.regexp_replace(rest, NO_SYMBOLS, "")).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"), "n_repeat_words": repeated_words(words),
        "_rest": size(rest), "_letters": size(F.regexp_replace(rest, r"\P{L}+", "")), "_capitals": size(F.regexp_replace(rest, r"\P{Lu}+", "")), "_digits": size(F.regexp_replace(rest, r"[^0-9]+", "")), "_common": common_counts(words, F.col("_lang"), common),
    }).drop("_words")
    letters, capitals, digits, symbols = (F.col(c) for c in ("_letters", "_capitals", "_digits", "n_symbols"))
    classes = [F.col("word_chars") - rest + letters - capitals, capitals, digits, symbols, rest - letters - digits - symbols, F.col("_chars") - F.col("word_chars")]
    return rows.withColumn("_classes", F.array(*[x.cast("long") for x in classes])).drop("_letters", "_capitals", "_digits", "_chars", "_rest")


def references(rows: DataFrame) -> DataFrame:
    """The summed histograms of each language: 1 / LANGUAGE_SHARE + 1 rows at most."""
    total = lambda c, n, name: F.array(*[F.coalesce(F.sum(F.get(c, F.lit(i))), F.lit(0)) for i in range(n)]).alias(name)
    return rows.groupBy(F.col("_lang").alias("_ref_lang")).agg(total(F.col("_classes"), len(CLASSES), "_ref_classes"), total(F.col("_common"), N_COMMON + 1, "_ref_common"))


def js_distance(counts: Column, reference: Column, n: int) -> Column:
    """Jensen-Shannon distance of two histograms of n bins; null where either is empty."""
    at = lambda c, i: F.get(c, F.lit(i)).cast("double")
    total = lambda c: reduce(lambda a, b: a + b, [at(c, i) for i in range(n)])

    def of(x: Column) -> Column:
        p, q = x["p"], x["q"]
        terms = [F.when(u > 0, u * F.log2(2 * u / (u + v))).otherwise(0.0) for i in range(n) for u, v in ((at(p, i) / x["n"], at(q, i) / x["m"]), (at(q, i) / x["m"], at(p, i) / x["n"]))]
        return F.sqrt(F.greatest(F.lit(0.0), reduce(lambda a, b: a + b, terms) / 2))

    both = F.struct(counts.alias("p"), reference.alias("q"), total(counts).alias("n"), total(reference).alias("m"))
    return let(both, lambda x: F.when((x["n"] > 0) & (x["m"] > 0), of(x)))


def verdicts(rows: DataFrame) -> DataFrame:
    """Measured rows with the two distances, base_failed and kept. It reads rows twice: for the references, then for the verdicts."""
    rows = rows.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    rows = rows.join(F.broadcast(references(rows.where("NOT base_failed"))), F.col("_lang") == F.col("_ref_lang"), "left")  # a row for each language
    long_enough = (F.col("n_words") >= MIN_WORDS) & (F.col("word_chars") >= MIN_CHARS)
    rows = once(rows, {"char_distance": js_distance(F.col("_classes"), F.col("_ref_classes"), len(CLASSES)), "word_distance": js_distance(F.col("_common"), F.col("_ref_common"), N_COMMON + 1)})
    far = long_enough & (F.coalesce(F.col("char_distance") > MAX_CHAR_DISTANCE, F.lit(False)) | F.coalesce(F.col("word_distance") > MAX_WORD_DISTANCE, F.lit(False)))
    return rows.withColumn("kept", ~F.col("base_failed") & ~far)


def quality(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """docs (without text) with RESULTS."""
    names = [f"c{k}" for k in range(len(docs.columns))]  # columns of docs may have any names
    at = dict(zip(docs.columns, names, strict=True))
    rows = docs.toDF(*names)
    counts = measured(rows, at[text], at[lang], common_words(rows, at[text], at[lang])).drop(at[text])
    return verdicts(stored(counts)).select(*[F.col(n).alias(c) for c, n in at.items() if c != text and c not in RESULTS], *RESULTS)


def quality_filter(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that pass, with the columns of docs. It reads docs three times and shuffles no text."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    at = dict(zip(docs.columns, names, strict=True))
    rows = docs.toDF(*names)
    return verdicts(measured(rows, at[text], at[lang], common_words(rows, at[text], at[lang]))).where("kept").select(*names).toDF(*docs.columns)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("char_distance", 4).alias("char_distance"), F.round("word_distance", 4).alias("word_distance"))
