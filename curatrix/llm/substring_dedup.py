"""Removal of repeated word windows: count-min sketches find the windows worth grouping, exact groups decide.

Round 1: every block sketches its windows, DEPTH cells each. Cells are sorted, and each shard gets its range of them: the cells
that the block raised, and which of them it raised twice. A shard adds all blocks' counters up. Counters never fall below the true
counts, so a window with a counter of 1 occurs once, and none that repeats is lost.
Round 2: each block sends the windows whose counters all reach 2, with the smallest document that has each; shards
group them exactly and tell which also start in a smaller document of another block.
Round 3: each block removes the words covered by windows that start in a smaller document.

Sketches use a fast hash, whose collisions only send more candidates to round 2. There windows are their words, joined by single
spaces, by their 128-bit BLAKE2b digests: no two different windows with one digest are known or can be made. A sketch has
2^WIDTH_BITS counters a shard and row, and shards grow with spark.sql.shuffle.partitions, so that a corpus of any size keeps
its error rate if partitions keep their size.

Defined results: null and blank texts have no words, and nothing of them is removed; a text shorter than a window
keeps all its words; rows with the same id are one document (no row removes words of the other); null ids come
before all others. Other columns pass through unchanged, whatever their names, unless they have the name of a result column.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .blocks import MESSAGE, Spans, answer, at_shards, back_in_blocks, bits, chunks, flat, from_blocks, in_blocks, in_order, message, mixed, partitions, raw, restarted, sliced, strings, texts, unbits, unvarint, varint, word_spans
from .common import table

#: Counters of a sketch row in one shard, as a power of two, and rows.
WIDTH_BITS, DEPTH = 24, 2
NO_ID = -(1 << 63)
STEP = 0xD6E8FEB86659FD93


def shard_bits(n: int) -> int:
    """Shards of a sketch row, as a power of two: half as many as partitions at least."""
    return max(n - 1, 1).bit_length() - 1


def with_places(values: np.ndarray, n_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of n_bits sorted, and the place of each. With its place in the low bits where that fits, as plain numbers sort much faster."""
    room = max(len(values) - 1, 1).bit_length()
    if n_bits + room > 64:
        order = np.argsort(values)
        return values[order], order
    packed = np.sort((values << np.uint64(room)) | np.arange(len(values), dtype=np.uint64))
    return packed >> np.uint64(room), (packed & np.uint64((1 << room) - 1)).astype(np.int64)


class Block:
    """Words and windows of a block's documents."""

    def __init__(self, rows: pa.Table, width: int, depth: int):
        self.rows = in_order(rows, "id", "text")
        self.data, self.at = texts(self.rows.column("text"))
        self.ids = self.rows.column("id").to_numpy()
        starts, ends, first, hashes, n = [], [], [np.zeros(1, np.int64)], [], 0
        for lo, hi in chunks(self.at):
            a = self.at[lo]
            part = self.data[a : self.at[hi]]
            s, e, f = word_spans(part, self.at[lo : hi + 1] - a)
            starts.append(s + a), ends.append(e + a), first.append(f[1:] + n), hashes.append(Spans(part)(s, e))
            n += len(s)
        empty = np.zeros(0, np.int64)
        self.starts, self.ends, self.first = np.concatenate([empty, *starts]), np.concatenate([empty, *ends]), np.concatenate(first)
        self.doc = np.repeat(np.arange(len(self.ids)), np.diff(self.first))
        self.width, self.n = width, n
        last = max(n - width + 1, 0)
        self.window = np.flatnonzero(self.doc[:last] == self.doc[n - last :])  # first words of windows
        words, h, times = mixed(np.concatenate([np.zeros(0, np.uint64), *hashes])), np.zeros(last, np.uint64), 1
        for k in range(width):
            h += words[k : k + last] * np.uint64(times)
            times = times * STEP & ((1 << 64) - 1)
        h = h[self.window]
        # cells of all rows: the row, then the shard, then the counter
        n_bits = depth + WIDTH_BITS
        cells = np.concatenate([(mixed(h, 7 * r) >> np.uint64(64 - n_bits)) | np.uint64(r << n_bits) for r in range(DEPTH)])
        cells, self.place = with_places(cells, n_bits + 1)
        new = np.flatnonzero(np.diff(cells, prepend=~cells[:1]))
        self.cell_of = np.zeros(len(cells), np.int64)
        self.cell_of[new[1:]] = 1
        self.cell_of = np.cumsum(self.cell_of)
        self.cells, self.twice = cells[new], np.diff(np.append(new, len(cells))) > 1
        self.shards, self.cuts = sliced((self.cells >> np.uint64(WIDTH_BITS)).astype(np.int64))

    def digests(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(each window's group of equal ones, numbered as they first occur; the groups' digests as two numbers). at: places in window."""
        joined, place = joined_words(self, np.ones(self.n, bool))
        w, data, known = self.window[at], joined.tobytes(), {}
        last = w + self.width - 1
        begin, end = place[self.starts[w]].tolist(), (place[self.starts[last]] + self.ends[last] - self.starts[last]).tolist()
        group = [known.setdefault(blake2b(data[x:y], digest_size=16).digest(), len(known)) for x, y in zip(begin, end, strict=True)]
        return np.array(group, np.int64), np.frombuffer(b"".join(known), "<u8").reshape(-1, 2)

    def candidates(self, often: np.ndarray, depth: int):
        """The windows that may repeat: (their first words, their groups; by group: digest, smallest document; the shards' slices). often: by cell, whether its counter reaches 2."""
        hit = np.zeros(len(self.cell_of), bool)
        hit[self.place] = often[self.cell_of]
        at = np.flatnonzero(hit.reshape(DEPTH, -1).all(axis=0))
        group, digest = self.digests(at)
        first = np.zeros(len(digest), np.int64)
        first[group[::-1]] = at[::-1]
        shard = (digest[:, 0] >> np.uint64(63 - depth)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        rank = np.zeros(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return self.window[at], rank[group], digest[order], self.ids[self.doc[self.window[first[order]]]], sliced(shard[order])


def sketch(width: int, depth: int):
    def work(rows: pa.Table) -> pa.Table:
        b, block = Block(rows, width, depth), rows.column("_block")[0].as_py()
        inside = (b.cells & np.uint64((1 << WIDTH_BITS) - 1)).astype(np.int64)
        steps = np.diff(inside, prepend=0)
        steps[b.cuts[:-1]] = inside[b.cuts[:-1]]
        return message(block, b.shards, varint(2 * steps + b.twice, b.cuts))

    return work


def merge(asked: pa.Table) -> pa.Table:
    """Adds the blocks' counters up and answers which of theirs reach 2."""
    steps, at = unvarint(asked.column("a"))
    cells, twice = restarted(steps >> 1, at), (steps & 1).astype(bool)
    often, by_cell = np.zeros(1 << WIDTH_BITS, bool), np.sort(cells.astype(np.uint32))
    often[by_cell[1:][by_cell[1:] == by_cell[:-1]]] = True
    often[cells[twice]] = True
    return answer(asked, bits(often[cells], at))


def candidates(width: int, depth: int):
    def work(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return message(0, np.zeros(0, np.int32))
        b, block = Block(rows, width, depth), rows.column("_block")[0].as_py()
        often = unbits(answers.sort_by("shard").column("a"), b.cuts)
        _, _, digest, ids, (shards, cuts) = b.candidates(often, depth)
        return message(block, shards, raw(digest, cuts), raw(ids, cuts))

    return work


def exact(asked: pa.Table) -> pa.Table:
    """Answers which windows of a block also start in a smaller document of another block."""
    (digest, at), (ids, _) = flat(asked.column("a"), "u8", 2), flat(asked.column("b"), "i8")
    order = np.lexsort((digest[:, 1], digest[:, 0]))
    new = np.any(np.diff(digest[order], axis=0, prepend=~digest[order[:1]]) != 0, axis=1)
    least = np.minimum.reduceat(ids[order], np.flatnonzero(new))
    smaller = np.zeros(len(ids), bool)
    smaller[order] = least[np.cumsum(new) - 1] < ids[order]
    return answer(asked, pa.nulls(asked.num_rows, pa.binary()), bits(smaller, at))


def removal(width: int, depth: int, schema: pa.Schema):
    def work(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return schema.empty_table()
        b = Block(rows, width, depth)
        of_sketch = answers.column("a").is_valid()
        window, group, _, ids, (_, cuts) = b.candidates(unbits(answers.filter(of_sketch).sort_by("shard").column("a"), b.cuts), depth)
        smaller = unbits(answers.filter(pc.invert(of_sketch)).sort_by("shard").column("b"), cuts)
        gone = window[smaller[group] | (b.ids[b.doc[window]] > ids[group])]
        hit = np.zeros(b.n + 1, np.int8)
        hit[gone] += 1  # places differ
        hit[gone + width] -= 1
        removed = np.cumsum(hit[:-1], dtype=np.int32) > 0
        data, place = joined_words(b, ~removed)
        count = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[b.first])
        made = {"n_words": np.diff(b.first), "n_removed": count(removed), "kept_text": strings(data, place[b.at])}
        return pa.table([made[f.name] if f.name in made else b.rows.column(f.name).cast(f.type) for f in schema], schema=schema)

    return work


def joined_words(b: Block, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the kept words of the texts, in each joined by one space; where every byte of data stands there): the byte after a kept word becomes that space, unless none follows."""
    last = np.zeros(len(keep), bool)
    k = np.flatnonzero(keep)
    last[k[np.flatnonzero(np.diff(b.doc[k], append=-1))]] = True
    edge = np.zeros(len(b.data) + 1, np.int8)
    edge[b.starts[keep]] += 1
    edge[b.ends[keep]] -= 1
    inside = np.cumsum(edge[:-1], dtype=np.int8) > 0
    data = b.data.copy()
    gaps = b.ends[keep & ~last]
    data[gaps], inside[gaps] = 32, True
    return data[inside], np.concatenate([[0], np.cumsum(inside, dtype=np.int64)])


def substring_dedup(docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = 13) -> DataFrame:
    """docs (without text) with n_words, n_removed and kept_text."""
    made = {"n_words": T.LongType(), "n_removed": T.LongType(), "kept_text": T.StringType()}
    rest = [c for c in docs.columns if c not in (text, *made)]
    names = [f"c{k}" for k in range(len(rest))]  # columns of docs may have any names
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(rest, names, strict=True)], F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = in_blocks(rows, "id", "text")
    depth = shard_bits(partitions(docs))
    first = at_shards(from_blocks(rows, sketch(width, depth)), DEPTH << depth, merge)
    second = at_shards(back_in_blocks(rows, first, candidates(width, depth), MESSAGE), 2 << depth, exact)
    out = T.StructType([*rows.select(*names).schema.fields, *[T.StructField(k, v) for k, v in made.items()]])
    found = back_in_blocks(rows, first.unionByName(second), removal(width, depth, to_arrow_schema(out)), out)
    return found.select(*[F.col(n).alias(c) for n, c in zip(names, rest, strict=True)], *made)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
