"""Language identification by Bayesian evidence fusion.

Four kinds of evidence are combined into log posteriors over LANGUAGES:
- the text: byte-trigram log likelihoods. The counts of the languages come from all labelled texts, by grouped
  aggregation; as neighbouring trigrams repeat each other's evidence, a text counts for at most EVIDENCE of them;
- the declared markup language, and the address suffix (the first path step or top-level domain that names a
  language): how often each value meets each language that the texts alone suggest, smoothed;
- the host: its languages as the texts alone suggest, smoothed towards those of its registered domain, these towards its
  top-level domain, and these towards the whole table; all counts are grouped aggregates.

A row is kept if it has letters enough to judge and its best language reaches MIN_POSTERIOR.

Defined results: null and blank texts are judged by the other evidence and not kept; null hosts, declared languages and
urls are no evidence; with no labelled text at all every language is as likely; repeated rows count and come out each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .blocks import chunks, texts
from .common import stored, table

LANGUAGES = ("en", "fr", "de", "es")
#: Trigrams are hashed to this many buckets; counts travel in parts of PART buckets.
BUCKETS, PART = 1 << 16, 1 << 12
EVIDENCE, MIN_LETTERS, MIN_POSTERIOR = 60, 20, 0.5
#: Weight of a parent's share, in rows, and of a channel's even share.
SMOOTHING = 20.0
SALTS = 16


def trigrams(data: np.ndarray) -> np.ndarray:
    """The bucket of the three bytes from each place, letters A to Z as lower case."""
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint32)
    return ((low[:-2] * 0x9E3779B1 + low[1:-1] * 0x85EBCA6B + low[2:] * 0xC2B2AE35) >> np.uint32(16)) if len(data) > 2 else np.zeros(0, np.uint32)


def trigram_counts(docs: DataFrame, text: str, label: str) -> np.ndarray:
    """Counts by language and bucket: an array of fixed size, whatever the corpus'."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(LANGUAGES), BUCKETS), np.int64)
        for batch in batches:
            data, at = texts(batch.column(0))
            labels = batch.column(1).to_pylist()
            for lo, hi in chunks(at):
                tri = trigrams(data[at[lo] : at[hi]])
                for d in range(lo, hi):
                    if labels[d] in LANGUAGES and at[d + 1] - at[d] > 2:
                        counts[LANGUAGES.index(labels[d])] += np.bincount(tri[at[d] - at[lo] : at[d + 1] - at[lo] - 2], minlength=BUCKETS)
        parts = [(k, p, counts[k, p * PART : (p + 1) * PART].tobytes()) for k in range(len(LANGUAGES)) for p in range(BUCKETS // PART)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*parts, strict=True)], ["language", "part", "counts"])

    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), np.int64) for x in rows.column("counts"))
        return pa.table({"language": rows.column("language").slice(0, 1), "part": rows.column("part").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "language long, part long, counts binary"
    found = np.zeros((len(LANGUAGES), BUCKETS), np.int64)
    for r in docs.select(text, label).mapInArrow(work, schema).groupBy("language", "part").applyInArrow(add, schema).collect():  # 64 rows
        found[r["language"], r["part"] * PART : (r["part"] + 1) * PART] = np.frombuffer(r["counts"], np.int64)
    return found


def log_likelihoods(counts: np.ndarray) -> np.ndarray:
    """By bucket and language."""
    return np.log((counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)).T.astype(np.float32)


def with_text_evidence(rows: DataFrame, likelihoods: np.ndarray) -> DataFrame:
    """rows with letters (how many bytes of letters the body has) and evidence (a number for each language) in place of body."""
    kept = [c for c in rows.columns if c != "body"]
    letter = np.zeros(256, bool)
    letter[65:91], letter[97:123], letter[128:] = True, True, True

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = texts(batch.column("body"))
            evidence, letters = np.zeros((len(batch), len(LANGUAGES))), np.zeros(len(batch), np.int64)
            for lo, hi in chunks(at):
                part, own = data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
                letters[lo:hi] = np.diff(np.concatenate([[0], np.cumsum(letter[part])])[own])
                sums = np.zeros((len(part) + 1, len(LANGUAGES)))
                np.cumsum(likelihoods[trigrams(part)], axis=0, out=sums[1 : max(len(part) - 1, 1)])
                n = np.maximum(np.diff(own) - 2, 0)
                evidence[lo:hi] = (sums[own[:-1] + n] - sums[own[:-1]]) * (EVIDENCE / (EVIDENCE + n))[:, None]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1, dtype=np.int32) * len(LANGUAGES)), pa.array(evidence.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(letters), lists], [*kept, "letters", "evidence"])

    schema = rows.select(*kept, F.lit(0).cast("long").alias("letters"), F.array(F.lit(0.0)).alias("evidence")).schema
    return rows.mapInArrow(work, schema)


def best(evidence: Column) -> Column:
    return F.get(F.array(*[F.lit(x) for x in LANGUAGES]), F.array_position(evidence, F.array_max(evidence)).cast("int") - 1)


def known(value: Column) -> Column:
    """The language that a tag such as en or fr-CA names, if it is one of LANGUAGES."""
    tag = F.lower(F.substring_index(F.substring_index(value, "-", 1), "_", 1))
    return F.when(tag.isin(*LANGUAGES), tag)


def channel(rows: DataFrame, value: str) -> dict[tuple[str, str], float]:
    """log P(value | language), the languages as texts alone suggest them; a row for each pair."""
    counts = {(r["v"], r["l"]): r["n"] for r in rows.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("v"), F.col("text_language").alias("l")).agg(F.count("*").alias("n")).collect()}
    total = {x: sum(counts.get((v, x), 0) for v in LANGUAGES) for x in LANGUAGES}
    return {(v, x): float(np.log((counts.get((v, x), 0) + SMOOTHING / len(LANGUAGES)) / (total[x] + SMOOTHING))) for v in LANGUAGES for x in LANGUAGES}


def channel_evidence(value: Column, logs: dict[tuple[str, str], float]) -> Column:
    out = F.array(*[F.lit(0.0)] * len(LANGUAGES))
    for v in LANGUAGES:
        out = F.when(value == v, F.array(*[F.lit(logs[v, x]) for x in LANGUAGES])).otherwise(out)
    return out


def host_priors(rows: DataFrame) -> DataFrame:
    """(host, prior): a host's shares of languages, smoothed towards its domain's, top-level domain's and the whole table's."""
    n = [F.col(f"n{k}") for k in range(len(LANGUAGES))]
    hosts = rows.where(F.col("host").isNotNull()).groupBy("host").agg(*[F.count_if(F.col("text_language") == x).alias(f"n{k}") for k, x in enumerate(LANGUAGES)])
    hosts = stored(hosts.withColumns({"domain": F.substring_index("host", ".", -2), "top": F.substring_index("host", ".", -1)}))
    counts = lambda *by: hosts.groupBy(*by).agg(*[F.sum(c).alias(f"n{k}") for k, c in enumerate(n)])

    def smoothed(parent: Column) -> Column:
        total = sum(n[1:], n[0])
        return F.array(*[(c + SMOOTHING * F.get(parent, F.lit(k))) / (total + SMOOTHING) for k, c in enumerate(n)]).alias("prior")

    whole = counts().select(smoothed(F.array(*[F.lit(1 / len(LANGUAGES))] * len(LANGUAGES))).alias("whole"))
    of = lambda df, key, name: df.select(F.col(key).alias(f"_{key}"), F.col("prior").alias(name))
    tops = of(counts("top").crossJoin(F.broadcast(whole)).select("top", smoothed(F.col("whole")).alias("prior")), "top", "above")  # one row beside each
    domains = counts("domain", "top").join(tops, F.col("top") == F.col("_top")).select("domain", smoothed(F.col("above")).alias("prior"))
    domains = of(domains, "domain", "above")
    return hosts.join(domains, F.col("domain") == F.col("_domain")).select("host", smoothed(F.col("above")).alias("prior"))


def fused(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    """rows (any keys, body, host, declared, suffix) without body, with letters, text_language, language, confidence and kept. labelled: texts with their languages, to count trigrams of."""
    likelihoods = log_likelihoods(trigram_counts(labelled, "text", "lang"))
    found = with_text_evidence(rows.withColumns({"declared": known(F.col("declared")), "suffix": known(F.col("suffix"))}), likelihoods)
    found = stored(found.withColumn("text_language", best(F.col("evidence"))))
    judged = found.where(F.col("letters") >= MIN_LETTERS)
    declared, suffix = channel(judged, "declared"), channel(judged, "suffix")
    priors = host_priors(judged).select(F.col("host").alias("_host"), "prior", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    salted = found.withColumn("_own", F.pmod(F.xxhash64(*[c for c in rows.columns if c != "body"], F.col("letters")), F.lit(SALTS)).cast("int"))  # a host may have any share of the rows
    joined = salted.join(priors, (F.col("host") == F.col("_host")) & (F.col("_own") == F.col("_salt")), "left")
    total = F.zip_with("evidence", F.zip_with(channel_evidence(F.col("declared"), declared), channel_evidence(F.col("suffix"), suffix), lambda a, b: a + b), lambda a, b: a + b)
    total = F.zip_with(total, F.coalesce("prior", F.array(*[F.lit(1 / len(LANGUAGES))] * len(LANGUAGES))), lambda a, b: a + F.log(b))
    joined = joined.withColumn("_total", total)
    spread = F.aggregate(F.transform("_total", lambda x: F.exp(x - F.array_max("_total"))), F.lit(0.0), lambda a, x: a + x)
    joined = joined.withColumns({"language": best(F.col("_total")), "confidence": F.round(1 / spread, 6)})
    return joined.withColumn("kept", (F.col("letters") >= MIN_LETTERS) & (F.col("confidence") >= MIN_POSTERIOR)).drop("_own", "_host", "_salt", "_total", "prior", "evidence")


def of_documents(docs: DataFrame) -> DataFrame:
    """Documents as rows to judge: the source stands for the host, the lang that came with the text for the declared one."""
    none = F.lit(None).cast("string")
    return docs.select(F.col("doc_id").cast("long"), F.lit(None).cast("long").alias("page_id"), F.col("text").alias("body"), F.col("source").alias("host"), F.col("lang").alias("declared"), none.alias("suffix"))


def of_pages(pages: DataFrame) -> DataFrame:
    """Pages as rows to judge: texts without markup, the html element's lang, the first path step or else the top-level domain."""
    html, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    host = F.lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#:]*)", 1))
    body = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"<[^>]*>", " ")
    step = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*/([A-Za-z]{2})(?:[/?#]|$)", 1)
    declared = F.regexp_extract(html, r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z_-]+)""", 1)
    suffix = F.coalesce(known(step), known(F.substring_index(host, ".", -1)))
    return pages.select(F.lit(None).cast("long").alias("doc_id"), F.col("page_id").cast("long"), body.alias("body"), F.nullif(host, F.lit("")).alias("host"), declared.alias("declared"), suffix.alias("suffix"))


def language_filter(docs: DataFrame) -> DataFrame:
    """The rows that are kept, with the columns of docs. Text, source and lang decide, so a row's verdict is that of its own text, whatever rows share its id."""
    names = [f"c{k}" for k in range(len(docs.columns))]  # columns of docs may have any names
    at = dict(zip(docs.columns, names, strict=True))
    text, source, lang, id_column = (F.col(at[c]) for c in ("text", "source", "lang", "doc_id"))
    rows = docs.toDF(*names).withColumn("key", F.xxhash64(id_column, text, source, lang))
    judged = fused(rows.select("key", id_column.cast("long").alias("id"), text.alias("body"), source.alias("host"), lang.alias("declared"), F.lit(None).cast("string").alias("suffix")), rows.select(text.alias("text"), lang.alias("lang")))
    rejected = judged.where(~F.col("kept")).select(F.col("key").alias("_key"), F.col("id").alias("_id")).distinct()
    return rows.join(rejected, (F.col("key") == F.col("_key")) & id_column.cast("long").eqNullSafe(F.col("_id")), "left_anti").drop("key").toDF(*docs.columns)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    found = fused(of_documents(docs).unionByName(of_pages(pages)), docs)
    return found.select("doc_id", "page_id", "host", "declared", "suffix", "letters", "text_language", "language", "confidence", "kept")
