"""I-Match fingerprints over several randomised lexicon subsets.

A document's terms are kept if their document frequency lies in a band of the corpus (neither too rare to survive an
edit, nor too common to tell texts apart). Every term of the band falls to TIMES of the SUBSETS overlapping lexicon
subsets, by its hash; the distinct terms that a document has of a subset make one signature, whatever their order. The
fingerprint is the list of signatures. Two documents are alike in the share of subsets, among those either has terms
of, with equal signatures.

Only DataFrame functions run here. All terms of all texts are counted, copies of a text once: of equal texts one row
counts. The band is one of shares, the same at any size; so with T distinct terms a text on average, at most T / MIN_SHARE
terms are in the lexicon. As T is at most half the mean length of a text, that bound is known before the lexicon is: up to
BROADCAST_TERMS the lexicon is broadcast, above it Spark joins it as it sees fit. A signature is the exclusive or of its
terms' hashes, added up where the document is, so that neither a term nor a text needs a row of its own in a shuffle:
texts travel once, by their id and hash, beside the beginnings that the documents before them need.

Defined results: null texts are empty; a text with no term in the lexicon has a fingerprint of its whole text, alike
to those of equal texts alone. Rows with null ids come first in the order of documents, rows of one id in the order of their
texts' hashes; rows equal in id and text are one document there, and come out as often as they are. The least long stands for null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import once, stored, table, words_of

SUBSETS = 128
#: So many subsets take each term.
TIMES = 2
#: The band of document frequency: this many distinct texts at least, and these shares of them.
MIN_DOCUMENTS, MIN_SHARE, MAX_SHARE = 2, 1 / 2000, 1 / 10
#: A lexicon that cannot have more terms than this is broadcast.
BROADCAST_TERMS = 20_000_000
#: Hex digits of a signature; an empty one is dashes.
DIGITS = 4
NO_ID = -(1 << 63)
KEY = ["_a", "_b"]


def terms(text: Column) -> Column:
    """The hashes of a text's distinct lower-case words."""
    return F.transform(F.array_distinct(words_of(F.lower(text))), lambda w: F.xxhash64(w))


def subsets(term: Column) -> list[Column]:
    """The numbers of the TIMES different subsets that take a term."""
    step = F.pmod(F.shiftright(term, 16), F.lit((SUBSETS - 1) // (TIMES - 1))) + 1  # so small that no step comes round
    return [F.pmod(F.pmod(term, F.lit(SUBSETS)) + step * k, F.lit(SUBSETS)) for k in range(TIMES)]


def lexicon(rows: DataFrame, n_texts: int) -> DataFrame:
    """(_term) of the terms of rows (text) whose document frequency lies in the band."""
    n = rows.select(F.explode(terms(F.col("text"))).alias("_term")).groupBy("_term").agg(F.count("*").alias("_n"))
    return n.where((F.col("_n") >= max(MIN_DOCUMENTS, MIN_SHARE * n_texts)) & (F.col("_n") <= MAX_SHARE * n_texts)).select("_term")


def signatures(found: DataFrame, band: DataFrame, sides: list[str], keys: list[str]) -> DataFrame:
    """(keys, sides) from rows (keys, term, sides: whether the term is one of that side): by side an array of signatures by subset, null where the side has no terms of it; rows without any are missing."""
    numbered = found.join(band, F.col("term") == F.col("_term"), "left_semi").select(*keys, "term", *sides, F.explode(F.array(*subsets(F.col("term")))).alias("subset"))
    each = numbered.groupBy(*keys, "subset").agg(*[F.bit_xor(F.when(F.col(s), F.xxhash64("term", "subset"))).alias(s) for s in sides])
    short = lambda x: F.shiftright(F.xxhash64(x), 48).cast("short")
    each = each.select(*keys, F.col("subset").cast("int").alias("subset"), *[F.when(F.col(s).isNotNull(), short(F.col(s))).alias(s) for s in sides])
    listed = each.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("subset", F.struct(*sides)))).alias("_of"))
    at = lambda s: F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), lambda k: F.try_element_at("_of", k)[s])
    some = lambda s: F.when(F.exists(F.map_values("_of"), lambda x: x[s].isNotNull()), at(s))
    return listed.select(*keys, *[some(s).alias(s) for s in sides])


def fingerprint(signed: Column, whole: Column) -> Column:
    """Each subset's signature, one after the other; of a document without lexicon terms, a hash of its text."""
    hexed = lambda x, n: F.lpad(F.lower(F.hex(x)), n, "0")
    one = lambda x: F.when(x.isNull(), "-" * DIGITS).otherwise(hexed(F.pmod(x.cast("int"), F.lit(1 << 16)), DIGITS))
    return F.when(signed.isNull(), F.concat(F.lit("="), hexed(whole, 16))).otherwise(F.array_join(F.transform(signed, one), ""))


def likeness(a: Column, b: Column, whole_a: Column, whole_b: Column) -> Column:
    """The share of subsets with equal signatures, among those that either document has terms of; 1 for equal fingerprints."""
    both = F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda x: x["a"].isNotNull() | x["b"].isNotNull())
    alike = F.size(F.filter(both, lambda x: x["a"] == x["b"])) / F.greatest(F.size(both), F.lit(1))
    return F.when(a.isNull() & b.isNull(), F.when(whole_a == whole_b, 1.0).otherwise(0.0)).when(a.isNull() | b.isNull(), 0.0).otherwise(F.round(alike, 4))


def ordered(rows: DataFrame) -> DataFrame:
    """rows (_a, _b, n_chars: one a document) with the key and length of the document before each: of the first, of the last one. In ranges of keys: a task sees its range, and one row of each other."""
    ranges = stored(rows.repartitionByRange(*KEY).withColumn("_range", F.spark_partition_id()))
    row = F.struct(*KEY, "n_chars")
    lasts = ranges.groupBy("_range").agg(F.max(row).alias("_last"))  # a row for each partition
    heads = lasts.withColumn("_prior", F.lag("_last").over(Window.orderBy("_range"))).crossJoin(F.broadcast(lasts.agg(F.max("_last").alias("_wrap"))))
    inner = ranges.withColumn("_inside", F.lag(row).over(Window.partitionBy("_range").orderBy(*KEY)))
    joined = inner.join(F.broadcast(heads.select("_range", F.coalesce("_prior", "_wrap").alias("_before"))), "_range")
    before = F.coalesce("_inside", "_before")
    return joined.select(*KEY, "n_chars", "_times", before["_a"].alias("_to_a"), before["_b"].alias("_to_b"), F.floor(before["n_chars"] / 2).cast("int").alias("_need"))


def imatch_with_edits(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every document."""
    body = F.coalesce(F.col(text), F.lit(""))
    docs = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("_a"), F.xxhash64(body).alias("_b"), body.alias("text"))
    sizes = docs.groupBy(*KEY).agg(F.max(F.char_length("text").cast("long")).alias("n_chars"), F.count("*").alias("_times"))
    order = ordered(sizes)
    firsts = order.groupBy(F.col("_b").alias("_text")).agg(F.min("_a").alias("_first"))  # one document of each distinct text
    order = order.join(firsts, (F.col("_b") == F.col("_text")) & (F.col("_a") == F.col("_first")), "left").withColumn("_counts", F.col("_first").isNotNull()).drop("_text", "_first")
    order = stored(order)
    n_texts, n_chars, most = order.agg(F.count_if("_counts"), F.coalesce(F.sum(F.when(F.col("_counts"), F.col("n_chars"))), F.lit(0)), F.max("_times")).first()
    if (most or 1) > 1:
        docs = docs.dropDuplicates(KEY)
    docs = docs.repartition(*KEY)  # the one exchange of texts; all that follows reads it
    known = docs.join(order.hint("shuffle_hash"), KEY)
    band = lexicon(known.where("_counts"), n_texts)
    if n_chars / 2 / max(n_texts, 1) / MIN_SHARE <= BROADCAST_TERMS:
        band = F.broadcast(band)
    target = [F.col("_to_a").alias("_a"), F.col("_to_b").alias("_b")]
    heads = known.select(*target, F.expr("substring(text, 1, _need)").alias("_head"))
    nexts = known.select(*KEY, "_to_a", "_to_b", F.explode(terms(F.col("text"))).alias("term"), F.lit(True).alias("_next"))
    nexts = signatures(nexts, band, ["_next"], [*KEY, "_to_a", "_to_b"]).select(*target, "_next")
    edited = docs.join(heads.hint("shuffle_hash"), KEY)
    edited = edited.select(*KEY, "text", F.char_length("text").cast("long").alias("n_chars"), F.concat(F.expr("substring(text, 1, char_length(text) - int(floor(char_length(text) / 2)))"), "_head").alias("edited"))
    digests = edited.select(*KEY, "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.xxhash64("edited").alias("_edited_b"))
    lists = once(edited, {"_own": terms(F.col("text")), "_changed": terms(F.col("edited"))}).select(*KEY, "_own", "_changed")
    sided = lambda c, own, changed: F.transform(c, lambda t: F.struct(t.alias("term"), F.lit(own).alias("own"), F.lit(changed).alias("changed")))
    listed = F.concat(sided(F.array_intersect("_own", "_changed"), True, True), sided(F.array_except("_own", "_changed"), True, False), sided(F.array_except("_changed", "_own"), False, True))
    signed = signatures(lists.select(*KEY, F.inline(listed)), band, ["own", "changed"], KEY)
    after = order.select(*target, F.col("_b").alias("_next_b"))
    rows = digests.join(order.select(*KEY, "_times"), KEY).join(after, KEY).join(signed, KEY, "left").join(nexts, KEY, "left")
    own, changed = F.col("own"), F.col("changed")
    return rows.select(
        F.nullif("_a", F.lit(NO_ID)).alias("id"), "n_chars", "edited_sha256", fingerprint(own, F.col("_b")).alias("fingerprint"), fingerprint(changed, F.col("_edited_b")).alias("edited_fingerprint"),
        likeness(own, changed, F.col("_b"), F.col("_edited_b")).alias("near_edited"), likeness(own, F.col("_next"), F.col("_b"), F.col("_next_b")).alias("near_next"), F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))),
    ).drop("col")


def op10_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch_with_edits(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
