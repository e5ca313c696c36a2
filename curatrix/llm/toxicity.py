"""Toxicity scores by non-negative positive-unlabelled learning.

A linear classifier is fitted with numpy on confirmed toxic texts and unlabelled ones, by the risk
  prior * R+(toxic) + max(0, R-(unlabelled) - prior * R-(toxic)),
whose second term takes the toxic share out of the unlabelled texts; where it would turn negative (over-fitting), the
step goes against it. Features are lower-case words and their beginnings, in the share of a text's words. Those that
are clearly more frequent among toxic than among unlabelled texts are chosen by grouped counts; fitting needs no more
of a text than these few. The prior is the toxic share of the labelled rows; in the end the intercept is set so that
the mean score of unlabelled texts equals it.

The fit takes at most MAX_TOXIC toxic and MAX_UNLABELLED unlabelled texts, by a hash of their ids, then of id and text where an id has many texts,
each text of an id once, whatever the corpus' size. Labels of held-out rows (crc32 of the id as text, modulo 4, is 2) are never read. Every text is scored whole.

Defined results: null and blank texts get the score of the intercept alone; without any toxic label all scores are the
same small number; repeated rows come out once each; null ids are not held out and not fitted on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import Spans, chunks, texts
from .common import stored, table

MAX_TOXIC, MAX_UNLABELLED, MAX_FEATURES = 8_000, 30_000, 4_096
#: Features are the top bits of hashes of words, and of their first bytes.
BITS, PREFIXES = 22, (4, 5, 6, 7, 8)
#: A feature's least number of toxic texts, times as frequent as in unlabelled ones, and standard errors above them.
MIN_TOXIC, MIN_LIFT, MIN_Z = 5, 2.0, 4.0
STEPS, RATE, DECAY = 300, 0.05, 1e-3
THRESHOLD = 0.3

LETTERS = np.zeros(256, bool)
LETTERS[97:123], LETTERS[128:] = True, True


def held_out(id_column: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def features(bodies: list[str | None], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, times) of the texts, by text and feature, and the texts' numbers of words. wanted: only these features (a mask)."""
    data, at = texts(pa.array([(b or "").lower() for b in bodies], pa.large_string()))
    found, words = [np.zeros(0, np.int64)], np.zeros(len(bodies), np.int64)
    for lo, hi in chunks(at):
        a = at[lo]
        part, own = data[a : at[hi]], at[lo : hi + 1] - a
        letter, edge = LETTERS[part], np.zeros(len(part) + 1, bool)
        edge[own] = True
        before, after = np.zeros(len(part), bool), np.zeros(len(part), bool)
        before[1:], after[:-1] = letter[:-1], letter[1:]
        starts, ends = np.flatnonzero(letter & (edge[:-1] | ~before)), np.flatnonzero(letter & (edge[1:] | ~after)) + 1
        doc = np.searchsorted(own, starts, "right") - 1 + lo
        words += np.bincount(doc, minlength=len(bodies))
        spans = Spans(part)
        for k in (0, *PREFIXES):
            i = np.flatnonzero(ends - starts > k)
            h = ((spans(starts[i], starts[i] + k if k else ends[i]) + np.uint64(k)) >> np.uint64(64 - BITS)).astype(np.int64)
            d = doc[i]
            if wanted is not None:
                ok = wanted[h]
                h, d = h[ok], d[ok]
            found.append((d << BITS) | h)
    key, times = np.unique(np.concatenate(found), return_counts=True)
    return key >> BITS, key & ((1 << BITS) - 1), times, words


def values(times: np.ndarray, words: np.ndarray) -> np.ndarray:
    """How strongly a text has a feature: the logarithm of its times in a thousand words."""
    return np.log1p(1000 * times / np.maximum(words, 50))


def sampled(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """(text, toxic, unlabelled) of the texts to fit on, and the toxic share of the labelled rows."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n, toxic = known.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    free = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    every = free.count()
    place = lambda c: F.pmod(F.xxhash64(c, F.lit("fit")), F.lit(1 << 30)) / (1 << 30)
    chosen = known.where((F.col("toxic") == 1) & (place("doc_id") < MAX_TOXIC / max(toxic, 1))).select(F.col("doc_id").alias("_id"), F.lit(True).alias("toxic"))
    rows = free.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"), "left")  # about MAX_TOXIC rows at most
    rows = rows.select("text", F.coalesce("toxic", F.lit(False)).alias("toxic"), (place("doc_id") < MAX_UNLABELLED / max(every, 1)).alias("unlabelled"), F.xxhash64("doc_id", "text", F.lit("row")).alias("_h"))
    rows = stored(rows.where("toxic OR unlabelled").dropDuplicates(["_h"]))
    for flag, most in (("toxic", MAX_TOXIC), ("unlabelled", MAX_UNLABELLED)):  # an id can have any number of texts
        if rows.where(flag).count() > most:
            last = rows.where(flag).select("_h").orderBy("_h").limit(most).agg(F.max("_h")).first()[0]
            rows = rows.withColumn(flag, F.col(flag) & (F.col("_h") <= last))
    return rows.where("toxic OR unlabelled").drop("_h"), toxic / n if n else 0.0


def chosen_features(rows: DataFrame) -> np.ndarray:
    """The features that mark toxic texts, in order."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << BITS), np.int32)
        for batch in batches:
            doc, feature, _, _ = features(batch.column(0).to_pylist())
            for k in (0, 1):
                counts[k] += np.bincount(feature[batch.column(1 + k).to_numpy(zero_copy_only=False)[doc]], minlength=1 << BITS).astype(np.int32)
        some = np.flatnonzero(counts.any(axis=0))
        for part in np.array_split(some, max(1, len(some) // 50_000)):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (part, counts[0][part].astype(np.int64), counts[1][part].astype(np.int64))], ["feature", "p", "u"])

    counts = rows.select("text", "toxic", "unlabelled").mapInArrow(work, "feature long, p long, u long").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    n, m = rows.agg(F.count_if("toxic"), F.count_if("unlabelled")).first()
    p, u = F.col("p") / max(n, 1), F.col("u") / max(m, 1)
    z = (p - u) / F.sqrt(F.greatest(u * (1 - u), F.lit(1e-9)) / max(n, 1) + 1e-9)
    best = counts.withColumn("z", z).where((F.col("p") >= MIN_TOXIC) & (p >= MIN_LIFT * u) & (F.col("z") >= MIN_Z)).orderBy(F.desc("z"), "feature").limit(MAX_FEATURES)
    return np.sort(np.array([r["feature"] for r in best.select("feature").collect()], np.int64))


def masked(chosen: np.ndarray) -> np.ndarray:
    wanted = np.zeros(1 << BITS, bool)
    wanted[chosen] = True
    return wanted


def reduced(rows: DataFrame, chosen: np.ndarray) -> pa.Table:
    """(toxic, unlabelled, features: places in chosen, values) of the texts to fit on."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = masked(chosen)
        for batch in batches:
            doc, feature, times, words = features(batch.column(0).to_pylist(), wanted)
            cuts = pa.array(np.searchsorted(doc, np.arange(len(batch) + 1)).astype(np.int32))
            place, value = pa.array(np.searchsorted(chosen, feature).astype(np.int32)), pa.array(values(times, words[doc]))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.ListArray.from_arrays(cuts, place), pa.ListArray.from_arrays(cuts, value)], ["toxic", "unlabelled", "places", "values"])

    return rows.select("text", "toxic", "unlabelled").mapInArrow(work, "toxic boolean, unlabelled boolean, places array<int>, values array<double>").toArrow()


def fit(rows: pa.Table, n_features: int, prior: float) -> tuple[np.ndarray, float]:
    """Weights and intercept, by Adam on the non-negative risk with logistic loss."""
    assert rows.num_rows <= MAX_TOXIC + MAX_UNLABELLED
    rows = rows.combine_chunks()
    toxic, free = (np.flatnonzero(rows.column(c).to_numpy()) for c in ("toxic", "unlabelled"))
    places, value = (pa.concat_arrays(rows.column(c).chunks).flatten().to_numpy() for c in ("places", "values"))
    doc = np.repeat(np.arange(len(rows)), rows.column("places").combine_chunks().value_lengths().to_numpy()) if len(rows) else np.zeros(0, np.int64)
    w, first, second = np.zeros(n_features + 1), np.zeros(n_features + 1), np.zeros(n_features + 1)  # the intercept last
    w[-1] = np.log(prior / (1 - prior))
    score = lambda: np.bincount(doc, w[places] * value, minlength=len(rows)) + w[-1]
    for t in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-score()))
        loss = -np.log(np.maximum(1 - p, 1e-12))
        g = np.zeros(len(rows))
        if loss[free].mean() - prior * loss[toxic].mean() >= 0:
            g[free] += p[free] / len(free)
            g[toxic] += prior * (p[toxic] - 1) / len(toxic) - prior * p[toxic] / len(toxic)
        else:
            g[free] -= p[free] / len(free)
            g[toxic] += prior * p[toxic] / len(toxic)
        slope = np.append(np.bincount(places, g[doc] * value, minlength=n_features) + DECAY * w[:-1], g.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        w -= RATE * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    margin = score()[free] - w[-1]
    low, high = -30.0, 30.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (1 / (1 + np.exp(-(margin + middle)))).mean() < prior else (low, middle)
    return w[:-1], middle


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of docs (doc_id, text)."""
    rows, prior = sampled(docs, labels)
    chosen, weights, intercept = np.zeros(0, np.int64), np.zeros(0), -6.0
    if 0 < prior < 1 and not rows.where("toxic").isEmpty() and not rows.where("unlabelled").isEmpty():
        chosen = chosen_features(rows)
        weights, intercept = fit(reduced(rows, chosen), len(chosen), prior)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = masked(chosen)
        for batch in batches:
            doc, feature, times, words = features(batch.column(1).to_pylist(), wanted)
            margin = np.bincount(doc, weights[np.searchsorted(chosen, feature)] * values(times, words[doc]), minlength=len(batch)) if len(chosen) else np.zeros(len(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-(margin + intercept))))], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
