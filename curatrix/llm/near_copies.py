"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of at least 0.8.

A node is a distinct set of shingles. Candidates come from two places: nodes whose five-word SimHash fingerprints are linked by
their Golay keys (`simhash`), and nodes that share one of BANDS keys of ROWS min-hashes each. The first finds copies with tiny
edits; at similarity 0.8 fingerprints differ by 7 to 10 bits of 64, and Golay keys for so many would need several hundred a text, while
a pair at similarity s shares a min-hash key with chance 1 - (1 - s^ROWS)^BANDS: 0.9997 at 0.8. Every link is
verified by exact Jaccard over the sets themselves, and links are joined into components.

Buckets of up to SMALL nodes are compared pair by pair. In larger ones some members at a time (pivots, GROWTH times as many
each round) are compared with all members that do not share their component yet, and leave the bucket; a bucket is done when one component
has all that is left of it. Members of the most large buckets are pivots first: the text that others were made from is like more of them
than they are like each other. So each pair of a bucket is compared, or joined already, or cannot be similar enough, and a group of near copies
costs a few comparisons a member. What cannot be similar enough is told by bounds that lose no link: shingles that one set alone has count for no pair, so
a set leaves a bucket where no other is of a size that it could be similar to with the rest; pairs have the same bound by the counts of
both, and then one by their counts of shingles in each range of hashes.

Defined results: words are runs without ASCII white space, ASCII letters lower; a text of one to four words has one
shingle; null and blank texts have the empty set and are copies of each other. Every row has its own verdict: of a
component one row stays, that with the smallest id (rows with null ids last), of equal ids the one with the least row
hash, and of repeated rows one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import chunks, mixed, texts, word_spans
from .common import compact, stored
from .simhash import components, fingerprints, with_keys, with_links, xxh64_spans

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 20, 5
SMALL = 16
GROWTH = 16
#: A pivot's set is held so many times, that its comparisons go to as many tasks.
SALTS = 16
#: Equal ranges of the hash space in which a set's members are counted: two sets share no more than the lesser counts.
CELLS = 128
#: Sets of sizes alike to e^(1/SIZES) are of one class where partners' sizes are looked up.
SIZES = 100


def shingles(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(each text's distinct shingle hashes, rising, one text after the other; where each text's begin, the end last)."""
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    starts, ends, first = word_spans(data, at)
    size = ends - starts
    joined_at = np.cumsum(size + 1) - size - 1  # the words one after the other, a space after each
    joined = np.full(int(size.sum()) + len(size), 32, np.uint8)
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    joined[np.repeat(joined_at, size) + inside] = data[np.repeat(starts, size) + inside]
    words = np.diff(first)
    count = np.where(words >= SHINGLE, words - SHINGLE + 1, np.minimum(words, 1))
    doc = np.repeat(np.arange(len(words)), count)
    begin = first[:-1][doc] + np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    last = np.minimum(begin + SHINGLE, first[1:][doc]) - 1
    h = xxh64_spans(joined, joined_at[begin], joined_at[last] + size[last])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.searchsorted(doc[new], np.arange(len(words) + 1))


def sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[at[1:]] - total[at[:-1]]


def sketches(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a hash of each set, the BANDS keys of each set)"""
    node = mixed(sums(mixed(h, 1), at) + np.diff(at).astype(np.uint64), 2)
    keys = np.zeros((len(node), BANDS), np.uint64)
    some = np.flatnonzero(np.diff(at))
    if len(some):
        for band in range(BANDS):
            key = np.full(len(some), np.uint64(band))
            for row in range(ROWS):
                key = mixed(key ^ np.minimum.reduceat(mixed(h, 10 + band * ROWS + row), at[some]), 4)
            keys[some, band] = key
    return node, keys


def per_text(batch: pa.RecordBatch):
    data, at = texts(batch.column(1))
    for lo, hi in chunks(at):
        yield lo, hi, *shingles(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])


def with_sketches(rows: DataFrame) -> DataFrame:
    """rows (_row, text, _id, _text_hash) as (_row, _id, _text_hash, node, fingerprint, keys)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, place = texts(batch.column(1))
            for lo, hi, h, at in per_text(batch):
                node, keys = sketches(h, at)
                prints = fingerprints(data[place[lo] : place[hi]], place[lo : hi + 1] - place[lo], SHINGLE)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS), pa.int32()), pa.array(keys.view(np.int64).reshape(-1)))
                own = [batch.column(k).slice(lo, hi - lo) for k in (0, 2, 3)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(node.view(np.int64)), pa.array(prints.view(np.int64)), lists], ["_row", "_id", "_text_hash", "node", "fingerprint", "keys"])

    return rows.select("_row", "text", "_id", "_text_hash").mapInArrow(work, "_row string, _id long, _text_hash long, node long, fingerprint long, keys array<long>")


def with_sets(rows: DataFrame) -> DataFrame:
    """rows (node, text) as (node, shingles, cells: how many shingles are in each range of hashes)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, h, at in per_text(batch):
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(h.view(np.int64)))
                cell = np.repeat(np.arange(hi - lo), np.diff(at)) * CELLS + (h // np.uint64(2**64 // CELLS)).astype(np.int64)
                counts = pa.array(np.bincount(cell, minlength=(hi - lo) * CELLS).astype(np.int32))
                cells = pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1) * CELLS, pa.int32()), counts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), lists, cells], ["node", "shingles", "cells"])

    return rows.select("node", "text").mapInArrow(work, "node long, shingles array<long>, cells array<int>")


def verified(pairs: DataFrame, sets: DataFrame, salts: int = 1) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough. salts: over how many tasks the pairs of one a go."""
    salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_of")
    near = sets.join(pairs.select(F.col("a").alias("node")).distinct(), "node", "left_semi").select(F.col("node").alias("_a"), F.col("shingles").alias("_left"), salt)
    far = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("_right")), "b").withColumn("_salt", F.pmod(F.xxhash64("b"), F.lit(salts)).cast("int"))
    both = far.join(near, (F.col("a") == F.col("_a")) & (F.col("_salt") == F.col("_of")))

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = x.values.to_numpy(), y.values.to_numpy()
                common = len(np.intersect1d(p, q, assume_unique=True)) if min(len(p), len(q)) >= SIMILARITY * max(len(p), len(q)) else 0
                ok.append(common >= SIMILARITY * (len(p) + len(q) - common) - 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return both.select("a", "b", "_left", "_right").mapInArrow(alike, "a long, b long")


def fingerprint_pairs(nodes: DataFrame) -> DataFrame:
    """Candidates (a, b) of nodes (node, fingerprint): each node with the least one of its fingerprint, and the least ones of linked fingerprints."""
    least = stored(nodes.groupBy("fingerprint").agg(F.min("node").alias("_least")))
    end = lambda side: least.select(F.col("fingerprint").alias(side), F.col("_least").alias(f"_{side}"))
    near = with_links(with_keys(least)).join(end("a"), "a").join(end("b"), "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    return near.unionByName(nodes.join(least, "fingerprint").where("node <> _least").select(F.col("_least").alias("a"), F.col("node").alias("b")))


def enough(common: Column, size: Column, other: Column) -> Column:
    """Whether sets of these sizes with so many shingles in common are similar enough."""
    return common >= F.lit(SIMILARITY / (1 + SIMILARITY)) * (size + other) - 1e-9


def with_partners(hot: DataFrame, sets: DataFrame) -> DataFrame:
    """The rows of hot (key, node, _size, ...) that may have a similar one in their bucket, with _common: how many of a node's shingles any other node of hot has."""
    here = sets.join(hot.select("node").distinct(), "node", "left_semi")
    alone = here.select("node", F.explode("shingles").alias("_s")).groupBy("_s").agg(F.count("*").alias("_n"), F.min("node").alias("node")).where("_n = 1")
    counted = hot.drop("_common").join(alone.groupBy("node").agg(F.count("*").alias("_alone")), "node", "left")
    counted = stored(counted.withColumn("_common", F.col("_size") - F.coalesce("_alone", F.lit(0))).drop("_alone").withColumn("_class", F.floor(F.log(F.greatest("_size", F.lit(1))) * SIZES).cast("int")))
    classes = counted.groupBy("key", "_class").agg(F.min("_size").alias("_least"), F.max("_common").alias("_most"))
    others = classes.select("key", F.col("_class").alias("_of"), F.col("_least").alias("_low"), F.col("_most").alias("_high"))
    reach = int(np.ceil(-np.log(SIMILARITY) * SIZES)) + 1
    met = classes.join(others, "key").where((F.abs(F.col("_class") - F.col("_of")) <= reach) & enough(F.least("_most", "_high"), F.col("_least"), F.col("_low")))
    low = met.groupBy("key", "_class").agg(F.min("_low").alias("_low"))
    return counted.join(low, ["key", "_class"]).where(enough(F.col("_common"), F.col("_size"), F.col("_low"))).drop("_class", "_low")


def near_components(sketched: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, label) of the nodes of sketched that have links. docs: (text, _text_hash)."""
    keyed = sketched.select("node", "keys").dropDuplicates(["node"]).select("node", F.explode("keys").alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("_n")).where("_n > 1")
    buckets = stored(keyed.join(sizes, "key"))
    similar = stored(fingerprint_pairs(sketched.select("node", "fingerprint").dropDuplicates(["node"])))
    chosen = buckets.select("node").unionByName(similar.select(F.explode(F.array("a", "b")).alias("node"))).distinct().join(sketched.groupBy("node").agg(F.min("_text_hash").alias("_hash")), "node")
    found = docs.join(chosen, F.col("_text_hash") == F.col("_hash")).groupBy("node").agg(F.first("text").alias("text"))
    sets = stored(with_sets(found))
    small = buckets.where(F.col("_n") <= SMALL)
    listed = small.groupBy("key").agg(F.sort_array(F.collect_list("node")).alias("_all"))
    first = listed.select(F.posexplode("_all").alias("_at", "a"), "_all").select("a", F.explode(F.expr("slice(_all, _at + 2, size(_all))")).alias("b"))
    links = stored(verified(first.distinct(), sets).unionByName(verified(similar, sets, SALTS)))
    sized = sets.select("node", F.size("shingles").alias("_size"), F.col("cells").alias("_cells"))
    hot, most = stored(buckets.where(F.col("_n") > SMALL).select("key", "node").join(sized, "node")), 1
    shared = hot.groupBy("node").agg(F.count("*").alias("_shared"))
    hot = stored(hot.join(shared, "node"))
    n = hot.count()
    hot, sets = compact(with_partners(hot, sets), n), compact(sets.join(hot.select("node").distinct(), "node", "left_semi"), n)
    labels = components(links)
    carried = ["key", "node", "_size", "_cells", "_shared", "_common"]
    shared_most = F.aggregate(F.zip_with("_cells", "_other_cells", lambda x, y: F.least(x, y)), F.lit(0), lambda n, x: n + x)  # fewer are shared, or as many
    size, other = F.col("_size"), F.col("_other")
    may_be_alike = enough(F.least("_common", "_other_common"), size, other) & enough(shared_most, size, other)
    while not hot.isEmpty():
        marked = hot.join(labels, "node", "left").select(*carried, F.coalesce("label", "node").alias("label"))
        ends = marked.groupBy("key").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi"), F.count("*").alias("_left")).where("_lo < _hi")
        marked = compact(marked.join(ends.select("key", "_left"), "key"), n)
        first = F.min(F.struct((-F.col("_shared")).alias("_few"), "node", "label", "_size", "_cells", "_common")).alias("_p")
        each = F.when(F.col("_left") <= SMALL, F.col("node")).otherwise(F.pmod(F.xxhash64("node", "key"), F.lit(most)))  # all that are left of a small one
        pivots = marked.groupBy("key", each.alias("_k")).agg(first)
        pivots = compact(pivots.select("key", *[F.col(f"_p.{x}").alias(y) for x, y in [("node", "a"), ("label", "_label"), ("_size", "_other"), ("_cells", "_other_cells"), ("_common", "_other_common")]]), n)
        pairs = marked.join(pivots, "key").where((F.col("label") != F.col("_label")) & may_be_alike).select("a", F.col("node").alias("b")).distinct()
        more = compact(verified(pairs, sets, SALTS), n)
        if not more.isEmpty():
            links = links.unionByName(more)
            labels = components(links)
        most *= GROWTH
        hot = compact(with_partners(marked.join(pivots.select("key", F.col("a").alias("node")), ["key", "node"], "left_anti").select(*carried), sets), n)
    return labels


def near_copy_filter(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component of near copies, with the columns of docs."""
    names = [f"c{k}" for k in range(len(docs.columns))]  # columns of docs may have any names
    at = dict(zip(docs.columns, names, strict=True))
    rows = docs.toDF(*names).withColumn("_row", F.sha2(F.to_json(F.struct(*names)), 256))
    body = F.coalesce(F.col(at[text]), F.lit(""))
    sketched = stored(with_sketches(rows.select("_row", body.alias("text"), F.col(at[id_column]).cast("long").alias("_id"), F.xxhash64(body).alias("_text_hash"))))
    labels = near_components(sketched, rows.select(body.alias("text"), F.xxhash64(body).alias("_text_hash")))
    grouped = sketched.join(labels, "node", "left").select("_row", "_id", F.coalesce("label", "node").alias("_label"))
    order = F.struct(F.col("_id").isNull().alias("none"), "_id", "_row")
    kept = stored(grouped.groupBy("_label").agg(F.min(order).alias("_best")).select(F.col("_best._row").alias("_kept")))
    many = stored(sketched.groupBy("_row").count().where("count > 1").select(F.col("_row").alias("_many")))
    out = rows.join(kept, F.col("_row") == F.col("_kept"), "left_semi")
    if not many.isEmpty():  # repeated rows: one of each
        again = out.join(many, F.col("_row") == F.col("_many"), "left_semi").dropDuplicates(["_row"])
        out = out.join(many, F.col("_row") == F.col("_many"), "left_anti").unionByName(again)
    return out.select(*names).toDF(*docs.columns)
