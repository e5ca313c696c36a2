"""Removal of repeated byte strings with longest-previous-factor arrays.

A byte goes if a string of `length` bytes that covers it also starts earlier: in a smaller document, or earlier in
the same one. All occurrences of such a string have to meet in one place without every suffix travelling there:

1. Each window of `length` bytes is represented by its least hashed gram (a minimizer); successive windows with the
   same minimizer form a segment. Equal windows have equal minimizers. Of its distinct segments a block sends
   - to the shard of the content the 128-bit BLAKE2b digest of the bytes, with the document: all segments of one
     digest but the earliest are copies, wholly removable (no two strings of one digest are known or can be made);
   - to the shard of the minimizer one entry for each minimizer, with a digest if the block has one content of it.
     Only where a minimizer stands in segments of different bytes can parts of them be equal, and only those are asked for.
   So a minimizer or a content that half the corpus shares reaches its shard once from each block.
2. Blocks send the bytes of the segments asked for that are no copies. Their shard sorts the suffixes of each group of
   segments and computes, from the previous and next smaller positions in suffix order, each suffix's longest previous
   factor. A window goes if that factor is at least its own length, so the first occurrence stays.
3. Each block removes what its own copies, the copies told in step 1 and the spans of step 2 cover.

A minimizer with more than MOST_SEGMENTS different segments is split: each part takes the windows whose own hash
falls to it, so that equal windows still meet; none is cut short. Segments that differ round one shared window meet in one part, however many they are.

Defined results: null texts are empty; texts shorter than `length` stay whole; rows with the same id count as different
documents, in a fixed order of their own; null ids come before all others. Matches never cross documents. A cut
may leave bytes that are no valid UTF-8 at its ends: kept_bytes has them exactly, while a kept text drops them. Other
columns pass through unchanged, whatever their names, unless they have the name of a result column.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .blocks import MESSAGE, Spans, answer, at_shards, back_in_blocks, bits, chunks, flat, from_blocks, in_blocks, in_order, message, mixed, partitions, raw, sliced, texts, unbits, unvarint, varint
from .common import table

LENGTH = 100
#: Bytes of a gram. Longer grams repeat less by chance but make more segments.
GRAM = 40
MOST_SEGMENTS = 20_000
#: Bytes of segments that one suffix array takes; a larger group is one of its own.
ARRAY_BYTES = 1 << 20
NO_ID = -(1 << 63)
PLACE_BITS = 26


def changes(*arrays: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before it, in any of the arrays; the first place always."""
    out = np.ones(len(arrays[0]), bool)
    out[1:] = np.any([a[1:] != a[:-1] for a in arrays], axis=0)
    return out


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of the hash space."""
    return (((h >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


class Block:
    """The segments of a block's documents."""

    def __init__(self, rows: pa.Table, length: int, shards: int):
        self.rows, self.length = in_order(rows, "id", "text"), length
        self.data, self.at = texts(self.rows.column("text"))
        self.ids = self.rows.column("id").to_numpy()
        found = [self.segments(lo, hi) for lo, hi in chunks(self.at)]
        self.start, self.end, self.key = (np.concatenate([np.zeros(0, t), *[f[k] for f in found]]) for k, t in enumerate((np.int64, np.int64, np.uint64)))
        self.doc = np.searchsorted(self.at, self.start, "right") - 1
        data, known = self.data.tobytes(), {}
        self.content = np.array([known.setdefault(self.digest(data[a:b]), len(known)) for a, b in zip(self.start.tolist(), self.end.tolist(), strict=True)], np.int64)
        digest = np.frombuffer(b"".join(known), "<u8").reshape(-1, 2)
        first = np.zeros(len(known), np.int64)
        first[self.content[::-1]] = np.arange(len(self.content))[::-1]  # starts rise with documents
        # distinct contents, in order of their shards
        shard = shard_of(digest[:, 0], shards)
        order = np.argsort(shard, kind="stable")
        self.first, self.digests = first[order], digest[order]
        self.content_shards, self.content_cuts = sliced(shard[order])
        self.rank = np.zeros(len(order), np.int64)  # by content, its place in first
        self.rank[order] = np.arange(len(order))
        # distinct minimizers, in order of their shards
        key = self.key[self.first]
        by_key = np.argsort(key, kind="stable")
        at = np.flatnonzero(changes(key[by_key])) if len(key) else by_key
        self.keys, self.contents = key[by_key][at], np.diff(np.append(at, len(by_key)))
        self.only = np.where(self.contents == 1, self.digests[by_key[at], 0], np.uint64(0))
        self.key_of = np.zeros(len(by_key), np.int64)  # by place in first, its place in keys
        self.key_of[by_key] = np.repeat(np.arange(len(at)), self.contents)
        self.key_shards, self.key_cuts = sliced(shard_of(self.keys, shards))

    @staticmethod
    def digest(content: bytes) -> bytes:
        return blake2b(content, digest_size=16).digest()

    def segments(self, lo: int, hi: int):
        """(starts, ends, minimizers)"""
        a, gram, n = self.at[lo], GRAM, self.length
        data, at = self.data[a : self.at[hi]], self.at[lo : hi + 1] - a
        size = np.diff(at)
        count = np.maximum(size - n + 1, 0)
        if not count.sum():
            return [np.zeros(0, np.int64)] * 2 + [np.zeros(0, np.uint64)]
        g = np.arange(len(data) - gram + 1)
        hashes = Spans(data)(g, g + gram)
        # the least of the grams of each window, the first of equals: a hash with its place in the low bits, place by place modulo
        low = (hashes & ~np.uint64((1 << PLACE_BITS) - 1)) | (g & ((1 << PLACE_BITS) - 1)).astype(np.uint64)
        grams, width = n - gram + 1, 1
        while 2 * width <= grams:
            low = np.minimum(low[: len(low) - width], low[width:])
            width *= 2
        low = np.minimum(low[: len(low) - (grams - width)], low[grams - width :]) if grams > width else low
        firsts = np.repeat(at[:-1] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())  # windows' starts
        place = (low[firsts] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        place += ((firsts - place + (1 << PLACE_BITS) - 1) >> PLACE_BITS) << PLACE_BITS  # the first such place at or after the window's start
        new = np.flatnonzero(np.concatenate([[True], (np.diff(place) != 0) | (np.diff(firsts) != 1)]))
        start, end = firsts[new], firsts[np.concatenate([new[1:] - 1, [len(firsts) - 1]])] + n
        return start + a, end + a, mixed(hashes[place[new]], 9)  # mixed anew: minimizers are small numbers, and shards are ranges

    def told(self, answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """By place in first: whether it is a copy of another block's, and into how many parts its bytes go (0: not asked for)."""
        answers = answers.sort_by("shard")
        copy = unbits(answers.filter(answers.column("a").is_valid()).column("a"), self.content_cuts)
        parts, _ = unvarint(answers.filter(answers.column("b").is_valid()).column("b"))
        return copy, parts[self.key_of]


def introduce(length: int, shards: int):
    """Contents go to the shards 0 to shards, minimizers to those after."""

    def work(rows: pa.Table) -> pa.Table:
        b, block = Block(rows, length, shards), rows.column("_block")[0].as_py()
        contents = message(block, b.content_shards, raw(b.digests, b.content_cuts), raw(b.ids[b.doc[b.first]], b.content_cuts))
        keys = message(block, b.key_shards + shards, raw(b.keys, b.key_cuts), raw(b.only, b.key_cuts), varint(b.contents, b.key_cuts))
        return pa.concat_tables([contents, keys])

    return work


def compare(shards: int):
    return lambda asked: (contested if asked.column("shard")[0].as_py() >= shards else copies)(asked)


def copies(asked: pa.Table) -> pa.Table:
    """Answers which contents of a block are in a smaller document of another block."""
    (digest, at), (ids, _) = flat(asked.column("a"), "u8", 2), flat(asked.column("b"), "i8")
    block = np.repeat(asked.column("block").to_numpy(), np.diff(at))
    order = np.lexsort((block, ids, digest[:, 1], digest[:, 0]))
    later = np.zeros(len(ids), bool)
    later[order] = ~changes(digest[order, 0], digest[order, 1])
    return answer(asked, bits(later, at))


def contested(asked: pa.Table) -> pa.Table:
    """Answers into how many parts the bytes of a minimizer's segments go: 0 if all blocks have the same content of it."""
    (key, at), (only, _), (n, _) = flat(asked.column("a"), "u8"), flat(asked.column("b"), "u8"), unvarint(asked.column("c"))
    order = np.argsort(key, kind="stable")
    new = changes(key[order])
    begin, group = np.flatnonzero(new), np.cumsum(new) - 1
    differ = np.maximum.reduceat(n[order], begin) > 1
    differ |= np.maximum.reduceat(only[order], begin) != np.minimum.reduceat(only[order], begin)
    parts = np.zeros(len(key), np.int64)
    parts[order] = np.where(differ, -(-np.add.reduceat(n[order], begin) // MOST_SEGMENTS), 0)[group]
    return answer(asked, pa.nulls(asked.num_rows, pa.binary()), varint(parts, at))


def supply(length: int, shards: int):
    """Sends the bytes of the segments asked for, each to every part that takes one of its windows."""

    def work(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return message(0, np.zeros(0, np.int32))
        b, block = Block(rows, length, shards), rows.column("_block")[0].as_py()
        copy, split = b.told(answers)
        ask = np.flatnonzero(~copy & (split > 0))
        whole, several = ask[split[ask] == 1], ask[split[ask] > 1]
        segments, part, of = [b.first[whole]], [np.zeros(len(whole), np.int64)], [np.ones(len(whole), np.int64)]
        for x, n in zip(b.first[several], split[several], strict=True):
            p = np.unique(part_of(b.data[b.start[x] : b.end[x]], length, n))
            segments.append(np.full(len(p), x)), part.append(p), of.append(np.full(len(p), n))
        i, part, of = np.concatenate(segments), np.concatenate(part), np.concatenate(of)
        key = np.where(of > 1, mixed(b.key[i] + part.astype(np.uint64), 3), b.key[i])
        order = np.lexsort((b.start[i], key))
        i, part, of, key = i[order], part[order], of[order], key[order]
        to, cuts = sliced(shard_of(key, shards))
        size = b.end[i] - b.start[i]
        at = np.concatenate([[0], np.cumsum(size)])
        body = b.data[np.repeat(b.start[i] - at[:-1], size) + np.arange(at[-1])]
        facts = np.stack([key.view(np.int64), part, of, b.ids[b.doc[i]], b.doc[i], b.start[i] - b.at[b.doc[i]], size], axis=1)
        return message(block, to, raw(facts, cuts), raw(body, at[cuts]))

    return work


def part_of(data: np.ndarray, length: int, parts: int) -> np.ndarray:
    """The part that takes each window of data."""
    starts = np.arange(len(data) - length + 1)
    return (mixed(Spans(data)(starts, starts + length), 5) % np.uint64(parts)).astype(np.int64)


def previous_factors(length: int):
    """Answers which windows start earlier elsewhere, as spans of each block's documents."""

    def work(asked: pa.Table) -> pa.Table:
        (facts, cut), (data, _) = flat(asked.column("a"), "i8", 7), flat(asked.column("b"))
        block = np.repeat(asked.column("block").to_numpy().astype(np.int64), np.diff(cut))
        key, part, of, ids, doc, start, size = facts.T
        at = np.cumsum(size) - size
        order = np.lexsort((start, doc, block, ids, key))
        cuts = np.flatnonzero(changes(key[order]))
        ends = np.concatenate([cuts[1:], [len(order)]])
        bytes_to = np.cumsum(size[order])
        found, lo = [], 0
        while lo < len(cuts):  # runs of whole groups
            base = bytes_to[cuts[lo] - 1] if cuts[lo] else 0
            hi = max(lo + 1, int(np.searchsorted(bytes_to[ends - 1], base + ARRAY_BYTES, "right")))
            o = order[cuts[lo] : ends[hi - 1]]
            n = size[o]
            to = np.concatenate([[0], np.cumsum(n)])
            text = data[np.repeat(at[o] - to[:-1], n) + np.arange(to[-1])]
            group = np.cumsum(np.concatenate([[False], np.diff(key[o]) != 0]))
            segment = np.repeat(np.arange(len(o)), n)
            window = np.flatnonzero(np.repeat(to[1:], n) - np.arange(len(text)) >= length)
            gone = window[factors(text, window, group[segment[window]], length)]
            for x in np.unique(segment[gone[of[o][segment[gone]] > 1]]):  # of a split group, each part answers for its own windows
                own = gone[segment[gone] == x]
                mine = part_of(text[to[x] : to[x + 1]], length, int(of[o][x]))[own - to[x]] == part[o][x]
                gone = np.setdiff1d(gone, own[~mine], assume_unique=True)
            where = segment[gone]
            found.append((block[o][where], doc[o][where], start[o][where] + gone - to[where]))
            lo = hi
        b, d, s = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((s, d, b))
        b, d, s = b[order], d[order], s[order]
        new = np.flatnonzero(np.concatenate([[True], (np.diff(b) != 0) | (np.diff(d) != 0) | (np.diff(s) > 1)])[: len(b)])
        last = np.concatenate([new[1:] - 1, [len(b) - 1]]) if len(new) else new
        to, cuts = sliced(b[new])
        return message(to, np.full(len(to), asked.column("shard")[0].as_py()), pa.nulls(len(to), pa.binary()), pa.nulls(len(to), pa.binary()), raw(np.stack([d[new], s[new], s[last] + length], axis=1), cuts))

    return work


def factors(text: np.ndarray, window: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Which windows (starts, in order of position; group: numbers that keep groups apart) have a longest previous factor of at least length.

    Ranks by the first 8, 16, 32 ... bytes give the order of the suffixes as far as length bytes. The longest
    previous factor of a suffix is what it shares with the nearest suffix of a smaller position before or after it in that order.
    """
    if not len(window):
        return np.zeros(0, bool)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    n = len(text)
    rank, width = np.zeros(n, np.uint64), min(8, length)
    for k in range(width):
        rank = (rank << np.uint64(8)) | padded[k : n + k]
    rank = np.unique(rank, return_inverse=True)[1]
    while 2 * width <= length:
        ahead = np.concatenate([rank[width:], np.zeros(width, rank.dtype)])
        rank = np.unique(rank * (n + 1) + ahead, return_inverse=True)[1]
        width *= 2
    if width < length:
        rank = np.unique(rank[window] * (n + 1) + rank[window + length - width], return_inverse=True)[1]
    else:
        rank = rank[window]
    suffixes = np.lexsort((window, rank, group))  # the suffix array of the windows
    place = np.arange(len(suffixes))
    rank, group = rank[suffixes], group[suffixes]
    out = np.zeros(len(window), bool)
    for step in (-1, 1):
        near = smaller(suffixes, step)
        ok = (near >= 0) & (near < len(suffixes))
        near = np.where(ok, near, place)
        out[suffixes] |= ok & (rank[near] == rank) & (group[near] == group)
    return out


def smaller(values: np.ndarray, step: int) -> np.ndarray:
    """Where the nearest smaller value stands, before (step -1) or after (1); -1 or len where there is none. By jumping over what is known to be larger."""
    n = len(values)
    ends = np.concatenate([values, [-1]])  # -1 stops every search, at places -1 and n alike
    near = np.arange(n) + step
    while True:
        larger = np.flatnonzero(ends[near] > values)
        if not len(larger):
            return near
        near[larger] = near[near[larger]]


def removal(length: int, shards: int, schema: pa.Schema):
    def work(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return schema.empty_table()
        b = Block(rows, length, shards)
        copy, _ = b.told(answers)
        own = np.arange(len(b.content)) != b.first[b.rank[b.content]]  # not the first of its content in this block
        gone = own | copy[b.rank[b.content]]
        spans, _ = flat(answers.filter(answers.column("c").is_valid()).column("c"), "i8", 3)
        edge = np.zeros(len(b.data) + 1, np.int32)
        np.add.at(edge, np.concatenate([b.start[gone], b.at[spans[:, 0]] + spans[:, 1]]), 1)
        np.add.at(edge, np.concatenate([b.end[gone], b.at[spans[:, 0]] + spans[:, 2]]), -1)
        gone = np.cumsum(edge[:-1], out=edge[:-1]) > 0
        before = np.zeros(len(gone), bool)
        before[1:] = gone[:-1]
        heads = np.zeros(len(gone) + 1, bool)
        heads[b.at] = True
        count = lambda x: np.diff(np.concatenate([[0], np.cumsum(x, out=edge[1:])])[b.at])  # noqa: E731  edge serves as room
        kept_at = np.concatenate([[0], np.cumsum(~gone, out=edge[1:])])[b.at].astype(np.int64)
        kept = pa.Array.from_buffers(pa.large_binary(), len(b.ids), [None, pa.py_buffer(kept_at), pa.py_buffer(b.data[~gone])]).cast(pa.binary())
        made = {"n_bytes": np.diff(b.at), "n_removed": count(gone), "n_spans": count(gone & (~before | heads[:-1])), "kept_bytes": kept}
        if "kept_text" in schema.names:
            made["kept_text"] = pa.array([x.as_py().decode(errors="ignore") for x in kept], pa.string())
        return pa.table([made[f.name] if f.name in made else b.rows.column(f.name).cast(f.type) for f in schema], schema=schema)

    return work


def suffix_dedup(docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = LENGTH, as_text: bool = False) -> DataFrame:
    """docs (without text) with n_bytes, n_removed, n_spans and kept_bytes, or kept_text if as_text."""
    made = {"n_bytes": T.LongType(), "n_removed": T.LongType(), "n_spans": T.LongType()} | ({"kept_text": T.StringType()} if as_text else {"kept_bytes": T.BinaryType()})
    rest = [c for c in docs.columns if c not in (text, *made)]
    names = [f"c{k}" for k in range(len(rest))]  # columns of docs may have any names
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(rest, names, strict=True)], F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = in_blocks(rows, "id", "text")
    n = max(1, partitions(docs) // 2)  # shards of a kind: contents, minimizers, bytes
    first = at_shards(from_blocks(rows, introduce(length, n)), 2 * n, compare(n))
    second = at_shards(back_in_blocks(rows, first, supply(length, n), MESSAGE), n, previous_factors(length))
    out = T.StructType([*rows.select(*names).schema.fields, *[T.StructField(k, v) for k, v in made.items()]])
    found = back_in_blocks(rows, first.unionByName(second), removal(length, n, to_arrow_schema(out)), out)
    return found.select(*[F.col(n).alias(c) for n, c in zip(names, rest, strict=True)], *made)


def suffix_dedup_filter(docs: DataFrame) -> DataFrame:
    """docs with the repeated strings cut out of the texts, n_chars as it is now; documents of which no word is left go."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    at = dict(zip(docs.columns, names, strict=True))
    cut = suffix_dedup(docs.toDF(*names), at["doc_id"], at["text"], as_text=True).where(F.col("kept_text").rlike(r"[^\x20\x09-\x0D]"))
    made = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return cut.select(*[made.get(c, F.col(n)).alias(c) for c, n in at.items()])


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))
