"""SimHash near-duplicates, with candidates from Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into segments of 22, 21 and 21 bits. Two fingerprints that differ in at most two bits
have a segment without error whose next segment (in a circle) has one error at most: with errors in two segments the
third is clean, and its next has one; with both errors in one segment, the other two are clean and one follows the
other. So a key is an exact segment with a codeword of the [23, 12, 7] Golay code for the next one. That code is
perfect: each word is within 3 bits of one codeword. Two words one bit apart have the same nearest codeword, unless one
is 3 bits from it; the other is then 4 bits from it at most. Each word therefore gives the index of its nearest codeword and, if it
is 3 bits away, those of the five codewords 4 bits away: about 16 keys a fingerprint, and no link is lost.

Fingerprints that share a key are compared, links are joined into components. Documents with equal fingerprints are
one node from the start. Inside a bucket of equal keys only a spanning forest of the links found leaves the task, and
large buckets are searched by looking up each fingerprint's neighbours, so nothing grows with the square of a bucket.

Defined results: null and blank texts have fingerprint zero and are linked like any other; a text of one or two words
has one shingle; null ids are left out of the choice of the smallest id (a component of null ids has none); repeated rows come out once each.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import chunks, texts, word_spans
from .common import compact, stored, table

SHINGLE, DISTANCE, SEED = 3, 2, 42
SEGMENTS = (22, 21, 21)
#: Runs of equal keys up to this size are compared pair by pair, longer ones by neighbours.
SMALL_RUN = 64
#: Fixed value: generator polynomial of the binary Golay code of length 23.
GENERATOR = 0b110001110101
#: The constants of XXH64.
PRIMES = [0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5]
P1, P2, P3, P4, P5 = (np.uint64(p) for p in PRIMES)
FULL = (1 << 64) - 1


def turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def xxh64_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of byte spans, all spans of one length at a time; spans over 256 bytes one by one."""
    out = np.zeros(len(starts), np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    at8 = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))  # the eight bytes from each place
    size = ends - starts
    order = np.argsort(size, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
        if not len(part):
            continue
        n, at = int(size[part[0]]), starts[part]
        if n > 256:
            out[part] = [xxhash.xxh64_intdigest(data[a : a + n].tobytes(), seed=seed) for a in at]
            continue
        k = 0
        if n >= 32:
            acc = [np.full(len(at), np.uint64(v & FULL)) for v in (seed + PRIMES[0] + PRIMES[1], seed + PRIMES[1], seed, seed - PRIMES[0])]
            while n - k >= 32:
                acc = [turned(a + at8[at + k + 8 * j] * P2, 31) * P1 for j, a in enumerate(acc)]
                k += 32
            h = turned(acc[0], 1) + turned(acc[1], 7) + turned(acc[2], 12) + turned(acc[3], 18)
            for a in acc:
                h = (h ^ (turned(a * P2, 31) * P1)) * P1 + P4
        else:
            h = np.full(len(at), np.uint64((seed + PRIMES[4]) & FULL))
        h = h + np.uint64(n)
        while n - k >= 8:
            h = turned(h ^ (turned(at8[at + k] * P2, 31) * P1), 27) * P1 + P4
            k += 8
        if n - k >= 4:
            h = turned(h ^ ((at8[at + k] & np.uint64(0xFFFFFFFF)) * P1), 23) * P2 + P3
            k += 4
        while n > k:
            h = turned(h ^ (data[at + k].astype(np.uint64) * P5), 11) * P1
            k += 1
        h = (h ^ (h >> np.uint64(33))) * P2
        h = (h ^ (h >> np.uint64(29))) * P3
        out[part] = h ^ (h >> np.uint64(32))
    return out


def fingerprints(data: np.ndarray, at: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """The fingerprints of texts given as bytes and offsets."""
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    starts, ends, first = word_spans(data, at)
    size = ends - starts
    joined_at = np.cumsum(size + 1) - size - 1  # the words one after the other, a space after each
    joined = np.full(int(size.sum()) + len(size), 32, np.uint8)
    inside = np.repeat(joined_at - np.concatenate([[0], np.cumsum(size)[:-1]]) if len(size) else joined_at, size) + np.arange(int(size.sum()))
    joined[inside] = data[np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
    words = np.diff(first)
    count = np.where(words >= shingle, words - shingle + 1, np.minimum(words, 1))
    doc = np.repeat(np.arange(len(words)), count)
    begin = first[:-1][doc] + np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    last = np.minimum(begin + shingle, first[1:][doc]) - 1
    h = xxh64_spans(joined, joined_at[begin], joined_at[last] + size[last])
    out = np.zeros(len(words), np.uint64)
    some = np.flatnonzero(count)
    if len(some):
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, (np.cumsum(count) - count)[some], axis=0, dtype=np.int32)
        out[some] = np.packbits(2 * ones > count[some][:, None], axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def with_fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fingerprint as a signed 64-bit number) of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = texts(batch.column(1))
            parts = [fingerprints(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], shingle) for lo, hi in chunks(at)]
            found = np.concatenate([np.zeros(0, np.uint64), *parts]).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["id", "fingerprint"])

    return docs.select(F.col(id_column).cast("long").alias("id"), F.col(text)).mapInArrow(work, "id long, fingerprint long")


class Golay:
    """Indices of codewords near 23-bit words."""

    def __init__(self):
        self.low, self.high = self.remainders(np.arange(1 << 12, dtype=np.int64)), self.remainders(np.arange(1 << 11, dtype=np.int64) << 12)
        errors = [sum(1 << b for b in c) for k in range(5) for c in combinations(range(23), k)]
        weight = np.array([bin(e).count("1") for e in errors])
        errors = np.array(errors, np.int64)
        syndrome = self.syndrome(errors)
        self.leader, self.far = np.zeros(1 << 11, np.int64), np.full((1 << 11, 5), -1, np.int64)
        self.leader[syndrome[weight < 4]] = errors[weight < 4]
        order = np.flatnonzero(weight == 4)
        order = order[np.argsort(syndrome[order], kind="stable")]
        s = syndrome[order]
        self.far[s, np.arange(len(s)) - np.searchsorted(s, s)] = errors[order]

    @staticmethod
    def remainders(x: np.ndarray) -> np.ndarray:
        for b in range(22, 10, -1):
            x = np.where(x >> b & 1, x ^ (GENERATOR << (b - 11)), x)
        return x

    def syndrome(self, x: np.ndarray) -> np.ndarray:
        return self.low[x & 0xFFF] ^ self.high[x >> 12]

    def indices(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in x, codeword indices), several for a place."""
        s = self.syndrome(x)
        i, k = np.nonzero(self.far[s] >= 0)
        return np.concatenate([np.arange(len(x)), i]), np.concatenate([x ^ self.leader[s], x[i] ^ self.far[s[i], k]]) >> 11


def keys(found: np.ndarray, golay: Golay) -> tuple[np.ndarray, np.ndarray]:
    """(places in found, keys): segment number, exact segment and codeword index of the next."""
    ends = np.cumsum(SEGMENTS)
    parts = [((found >> np.uint64(e - w)) & np.uint64((1 << w) - 1)).astype(np.int64) for e, w in zip(ends, SEGMENTS, strict=True)]
    out = []
    for k in range(3):
        i, code = golay.indices(parts[(k + 1) % 3])
        out.append((i, (k << 34) | (parts[k][i] << 12) | code))
    return np.concatenate([i for i, _ in out]), np.concatenate([x for _, x in out])


def with_keys(nodes: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        golay = Golay()
        for batch in batches:
            found = batch.column(0).to_numpy()
            i, key = keys(found.view(np.uint64), golay)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(found[i])], ["key", "fingerprint"])

    return nodes.select("fingerprint").mapInArrow(work, "key long, fingerprint long")


def linked(key: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (place, place of its root) of the links inside runs of equal keys; found rises within a run."""
    n = len(key)
    begin = np.flatnonzero(np.concatenate([[True], np.diff(key) != 0]))[: n]
    size = np.diff(np.append(begin, n))
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    run, step = np.repeat(size, size), 1
    left = np.repeat(begin + size, size) - np.arange(n)  # members from here to the run's end
    small = np.flatnonzero((run > 1) & (run <= SMALL_RUN))
    while len(small := small[left[small] > step]):
        near = np.bitwise_count(found[small] ^ found[small + step]) <= DISTANCE
        a.append(small[near]), b.append(small[near] + step)
        step += 1
    masks = [sum(1 << x for x in c) for k in (1, 2) for c in combinations(range(64), k)]
    for x, m in zip(begin[size > SMALL_RUN], size[size > SMALL_RUN], strict=True):
        own = np.sort(found[x : x + m])
        places = x + np.argsort(found[x : x + m], kind="stable")
        for mask in masks:
            other = own ^ np.uint64(mask)
            at = np.minimum(np.searchsorted(own, other), m - 1)
            hit = np.flatnonzero((own[at] == other) & (own < other))
            a.append(places[hit]), b.append(places[at[hit]])
    root = roots(n, np.concatenate(a), np.concatenate(b))
    moved = np.flatnonzero(root != np.arange(n))
    return moved, root[moved]


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least place that each place is joined to."""
    root = np.arange(n)
    while len(a):
        x, y = root[a], root[b]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (jumped := root[root]).tobytes() != root.tobytes():
            root = jumped
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


def with_links(keyed: DataFrame) -> DataFrame:
    """Verified links (a, b) between different fingerprints: enough of them to join all that are linked."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, found = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def flush(end: int) -> pa.RecordBatch:
            x, y = linked(key[:end], found[:end].view(np.uint64))
            return pa.RecordBatch.from_arrays([pa.array(found[:end][x]), pa.array(found[:end][y])], ["a", "b"])

        for batch in batches:
            key, found = np.concatenate([key, batch.column(0).to_numpy()]), np.concatenate([found, batch.column(1).to_numpy()])
            if len(key) and (end := int(np.searchsorted(key, key[-1]))):  # the last run may go on
                yield flush(end)
                key, found = key[end:], found[end:]
        if len(key):
            yield flush(len(key))

    return keyed.repartition("key").sortWithinPartitions("key", "fingerprint").mapInArrow(work, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, label) of all nodes in links (a, b): the least node joined to each. Labels spread along links and jump to their labels' labels, round by round, until none changes."""
    both = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    n = both.count()
    both = compact(both, n)
    labels = compact(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")), n)
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("_node")).agg(F.min("label").alias("_near"))
        jump = labels.select(F.col("node").alias("_at"), F.col("label").alias("_jump"))
        step = labels.join(near, F.col("node") == F.col("_node"), "left").join(jump, F.col("label") == F.col("_at"), "left")
        step = compact(step.select("node", F.least("label", "_near", "_jump").alias("label"), (F.least("label", "_near", "_jump") != F.col("label")).alias("_moved")), n)
        labels = step.drop("_moved")
        if step.where("_moved").isEmpty():
            return labels


def simhash_components(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fingerprint, component_id) of every row."""
    found = stored(with_fingerprints(docs, id_column, text, shingle))
    nodes = found.groupBy("fingerprint").agg(F.min("id").alias("_least"))
    labels = components(with_links(with_keys(nodes)))
    nodes = nodes.join(labels, F.col("fingerprint") == F.col("node"), "left").withColumn("_label", F.coalesce("label", "fingerprint")).select("fingerprint", "_label", "_least")
    least = nodes.groupBy(F.col("_label").alias("_of")).agg(F.min("_least").alias("component_id"))
    nodes = nodes.join(least, F.col("_label") == F.col("_of")).select(F.col("fingerprint").alias("_fingerprint"), "component_id")
    return found.join(nodes, F.col("fingerprint") == F.col("_fingerprint")).select("id", "fingerprint", "component_id")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
