"""Blocks of documents that exchange arrays with shards of a hash space.

Operators that compare every document with every other work in rounds. Documents are dealt once into blocks; each
round reads that exchange again. A block sends one row to each shard that it has entries for: the entries are sorted
by hash, shards are ranges of the hash space, and a row holds a slice of the block's arrays as binary columns. A shard
reads all its rows as whole arrays and answers each row in its own order, which the block can make again because its
work is deterministic. No step loops over rows, so that a row costs what any row of a shuffle costs. No group is
larger than a block, or than what the blocks send to one shard: an entry that half the corpus shares reaches its shard
once from each block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: a, b, c: what an operator sends, as binary arrays.
MESSAGE = "block int, shard int, a binary, b binary, c binary"
#: Bytes of text that the numpy steps take at a time.
CHUNK = 1 << 19
BLOCKS_A_PARTITION = 2

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def in_blocks(docs: DataFrame, *columns: str) -> DataFrame:
    """docs with _block, by a hash of these columns: a partition for each block. Rows that are equal in all of them share a block."""
    n = BLOCKS_A_PARTITION * partitions(docs)
    return docs.withColumn("_block", F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")).repartitionById(n, F.col("_block"))


def from_blocks(docs: DataFrame, work: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """The rows that each block sends."""
    return docs.groupBy("_block").applyInArrow(work, MESSAGE)


def at_shards(messages: DataFrame, shards: int, work: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """The answers of each shard."""
    return messages.repartitionById(shards, F.col("shard")).groupBy("shard").applyInArrow(work, MESSAGE)


def back_in_blocks(docs: DataFrame, answers: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema) -> DataFrame:
    """What each block makes of its documents and of the answers to it."""
    answers = answers.repartitionById(BLOCKS_A_PARTITION * partitions(docs), F.col("block"))
    return docs.groupBy("_block").cogroup(answers.groupBy("block")).applyInArrow(work, schema)


def message(block: np.ndarray | int, shard: np.ndarray, *bodies: pa.Array) -> pa.Table:
    n = len(shard)
    bodies = [*bodies, *[pa.nulls(n, pa.binary())] * (3 - len(bodies))]
    return pa.table([pa.array(np.broadcast_to(np.asarray(x, np.int32), n)) for x in (block, shard)] + bodies, ["block", "shard", "a", "b", "c"])


def answer(asked: pa.Table, *bodies: pa.Array) -> pa.Table:
    """A row back for each row."""
    return message(asked.column("block").to_numpy(), asked.column("shard").to_numpy(), *bodies)


def sliced(shard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the shards that occur, where each's entries begin, the end last) of the rising shard numbers of entries."""
    at = np.flatnonzero(np.diff(shard, prepend=-1))
    return shard[at], np.append(at, len(shard))


def raw(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """Slices of an array (at: where each begins, the end last) as one binary value each."""
    values = np.ascontiguousarray(values)
    size = values.dtype.itemsize * (values.shape[1] if values.ndim > 1 else 1)
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(np.ascontiguousarray(at * size, np.int64)), pa.py_buffer(values.reshape(-1).view(np.uint8))]).cast(pa.binary())


def flat(column: pa.ChunkedArray, kind: str = "u1", width: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The values (rows of width numbers, if over 1) of all of a column's bodies, and where each body begins, the end last."""
    data, at = texts(column, pa.large_binary(), b"")
    values = np.frombuffer(data.tobytes(), f"<{kind}")
    at = at // (np.dtype(kind).itemsize * width)
    return (values.reshape(-1, width) if width > 1 else values), at


def varint(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """Slices of small numbers, seven bits a byte."""
    values = np.asarray(values, np.uint64)
    size = np.ones(len(values), np.int64)
    for k in range(1, 10):
        size += values >= np.uint64(1 << 7 * k)
    end = np.cumsum(size)
    start, out = end - size, np.zeros(int(end[-1]) if len(end) else 0, np.uint8)
    for k in range(int(size.max(initial=0))):
        some = np.flatnonzero(size > k) if k else slice(None)
        out[start[some] + k] = ((values[some] >> np.uint64(7 * k)) & np.uint64(127)) | ((size[some] > k + 1).astype(np.uint64) << np.uint64(7))
    return raw(out, np.concatenate([[0], end])[at])


def unvarint(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all of a column's bodies, and where each body begins, the end last."""
    data, at = flat(column)
    end = np.flatnonzero(data < 128)
    start = np.concatenate([[0], end + 1])[: len(end)]
    size = end - start + 1
    values = (data[start] & 127).astype(np.int64)
    for k in range(1, int(size.max(initial=0))):
        some = np.flatnonzero(size > k)
        values[some] |= (data[start[some] + k] & 127).astype(np.int64) << 7 * k
    return values, np.searchsorted(start, at)


def bit_places(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(each entry's bit, each slice's first byte, the end last), where every slice begins a byte."""
    n = np.diff(at)
    first = np.concatenate([[0], np.cumsum((n + 7) // 8)])
    return np.repeat(first[:-1] * 8 - at[:-1], n) + np.arange(at[-1]), first


def bits(flags: np.ndarray, at: np.ndarray) -> pa.Array:
    """Slices of flags."""
    place, first = bit_places(at)
    out = np.zeros(int(first[-1]) * 8, bool)
    out[place] = flags
    return raw(np.packbits(out), first)


def unbits(column: pa.ChunkedArray, at: np.ndarray) -> np.ndarray:
    """The flags again, in slices as sent."""
    return np.unpackbits(flat(column)[0])[bit_places(at)[0]].astype(bool)


def restarted(steps: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Running sums of differences that begin anew in every slice."""
    total, n = np.cumsum(steps), np.diff(at)
    first = at[:-1][n > 0]
    return total - np.repeat(total[first] - steps[first], n[n > 0])


def texts(column: pa.ChunkedArray | pa.Array, kind: pa.DataType = pa.large_string(), empty: str | bytes = "") -> tuple[np.ndarray, np.ndarray]:  # noqa: B008
    """The bytes of all texts (null: empty) and where each begins, the end last."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], kind)
    column = column.cast(kind).fill_null(empty)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)), at - at[0]


def strings(data: np.ndarray, at: np.ndarray) -> pa.Array:
    """The texts again."""
    return pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, pa.py_buffer(np.ascontiguousarray(at, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.string())


def chunks(at: np.ndarray, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about this many bytes."""
    lo = 0
    while lo < len(at) - 1:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most, "right")) - 1)
        yield lo, hi
        lo = hi


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and each text's first word (the number of words last)."""
    word = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    starts, ends = np.flatnonzero(word & (edge[:-1] | ~before)), np.flatnonzero(word & (edge[1:] | ~after)) + 1
    return starts, ends, np.searchsorted(starts, at)


class Spans:
    """64-bit hashes of any byte spans of one text, from sums of byte values times powers of an odd base."""

    base = np.uint64(0x9E3779B97F4A7C15 | 1)
    unbase = np.uint64(pow(int(base), -1, 1 << 64))
    values = np.random.default_rng(13).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
    _up = _down = np.ones(1, np.uint64)

    @classmethod
    def powers(cls, n: int) -> None:
        if len(cls._up) <= n:
            one = np.ones(1, np.uint64)
            cls._up = np.cumprod(np.concatenate([one, np.full(n, cls.base)]), dtype=np.uint64)
            cls._down = np.cumprod(np.concatenate([one, np.full(n, cls.unbase)]), dtype=np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.powers(n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[data] * self._up[:n], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self._down[starts] + (ends - starts).astype(np.uint64))


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & ((1 << 64) - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def in_order(rows: pa.Table, id_column: str, text: str) -> pa.Table:
    """The rows of a block by id, then text: the same order in every round."""
    return rows.sort_by([(id_column, "ascending"), (text, "ascending")])
