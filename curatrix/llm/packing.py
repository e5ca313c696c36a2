"""Best-fit packing of token sequences by linear grouping.

Large pieces (over a share of the capacity, SMALL_SHARES) are put in order of length and cut into GROUPS groups of equal
cardinality; within a group lengths are rounded up to the largest. With so few sizes, the numbers of all configurations (which
sizes share a sequence) are optimised together: the linear programme of fewest sequences that hold every size as often as it
occurs, solved by column generation, whose next configuration is a knapsack over the sizes' dual prices. Whole numbers of these are
used. Then the actual pieces take the slots of their group; the few large ones left over, and after them the small pieces, go best-fit
into the room that is really left. Pieces of the whole capacity are sequences of their own and in no group.

The plan needs only how many pieces there are of each length (capacity rows at most), so it is made on the driver at
any corpus size; it says which range of the pieces of one length goes where. The pieces are numbered within their
length, over salted parts so that no length is one task's, and look up their place.

Defined results: a null text is empty and becomes a piece of its end token alone; repeated rows are packed once each;
an empty table gives no rows. Other columns than id and text are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .blocks import partitions
from .common import stored, table
from .encoders import vocabulary

CAPACITY, END = 2048, 0
GROUPS = 48
#: What counts as small, as shares of the capacity: the plan with fewest sequences is taken.
SMALL_SHARES = (0.3, 0.4, 0.5)
#: Pivots of the linear programme at most: every step has a whole plan, later ones fewer sequences.
PIVOTS = 2000


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids): each document's ids and an end token, cut only where they exceed the capacity; ids are little-endian unsigned 32-bit numbers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary(tokenizer)
        for batch in batches:
            rows: list[tuple] = []
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encoder.encode(body.as_py() or ""), END], "<u4")
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                rows += [(doc, k, a, b - a, ids[a:b].tobytes()) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], t) for t in kinds], ["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col(id_column).cast("long"), F.col(text)).mapInArrow(work, "doc_id long, piece int, start long, length long, ids binary")


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Which sizes share a sequence (size's number -> how many), and in how many sequences, so that few hold all that is demanded. Rounded down: some of each size may be left."""
    if not sizes:
        return []
    n, need = np.array(sizes), np.array(demand, float)
    basis = np.diag(capacity // n).astype(float)  # a column for each configuration
    for _ in range(PIVOTS):
        prices = np.linalg.solve(basis.T, np.ones(len(n)))
        best = fullest(n, prices, capacity)
        if best @ prices <= 1 + 1e-7:
            break
        times, change = np.linalg.solve(basis, need), np.linalg.solve(basis, best)
        some = np.flatnonzero(change > 1e-9)
        basis[:, some[np.argmin(np.maximum(times[some], 0) / change[some])]] = best
    times = np.floor(np.linalg.solve(basis, need) + 1e-6).astype(int)
    return [({int(j): int(basis[j, k]) for j in np.flatnonzero(basis[:, k])}, int(times[k])) for k in range(len(n)) if times[k] > 0]


def fullest(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> np.ndarray:
    """The configuration of highest price: a knapsack by dynamic programming, each size any number of times."""
    value, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.argsort(sizes)
    by_size, gain = sizes[order], prices[order]
    for c in range(int(by_size[0]), capacity + 1):
        fit = int(np.searchsorted(by_size, c, "right"))
        with_each = value[c - by_size[:fit]] + gain[:fit]
        k = int(np.argmax(with_each))
        value[c], last[c] = (with_each[k], k) if with_each[k] > value[c - 1] else (value[c - 1], -1)
    use, c = np.zeros(len(sizes)), capacity
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            use[order[last[c]]] += 1
            c -= int(by_size[last[c]])
    return use


class Plan:
    """Where pieces go, by their length and their number among the pieces of that length."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY, small_share: float = SMALL_SHARES[0], groups: int = GROUPS):
        self.capacity, self.sequences = capacity, 0
        self.rows: list[tuple[int, int, int, int, int]] = []  # length, first number, how many, first sequence, offset
        self.room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # runs (first sequence, how many) by room left
        small = int(capacity * small_share)
        left = self.large({n: c for n, c in counts.items() if n > small and c}, groups)
        left += [(n, c, 0) for n, c in counts.items() if n <= small and c]
        for n, count, first in sorted(left, reverse=True):
            self.best_fit(n, count, first)
        lengths, first, _, sequence, offset = np.array(sorted(self.rows), np.int64).reshape(-1, 5).T
        self.key, self.first, self.sequence, self.offset = (lengths << 40) + first, first, sequence, offset

    def large(self, counts: dict[int, int], groups: int) -> list[tuple[int, int, int]]:
        """Packs large pieces by configurations; those left over as (length, how many, first number)."""
        if full := counts.get(self.capacity):
            self.rows.append((self.capacity, 0, full, self.sequences, 0))
            self.sequences += full
        lengths = np.array(sorted((n for n in counts if n < self.capacity), reverse=True), np.int64)
        to = np.cumsum([counts[n] for n in lengths.tolist()])
        total = int(to[-1]) if len(to) else 0
        cuts = sorted({total * k // groups for k in range(groups + 1)})
        at, end = list(cuts[:-1]), cuts[1:]
        sizes = [int(lengths[np.searchsorted(to, a, "right")]) for a in at]  # of each group's largest, falling
        for use, times in configurations(sizes, [e - a for a, e in zip(at, end, strict=True)], self.capacity):
            times = min([times, *((end[j] - at[j]) // n for j, n in use.items())])
            slots = []
            for j, n in use.items():
                slots += [at[j] + k * times for k in range(n)]
                at[j] += n * times
            if times:
                self.substitute(slots, times, lengths, to)
        left = []
        for a, e in zip(at, end, strict=True):
            while a < e:
                k = int(np.searchsorted(to, a, "right"))
                n = min(e, int(to[k])) - a
                left.append((int(lengths[k]), n, a - (int(to[k - 1]) if k else 0)))
                a += n
        return left

    def substitute(self, slots: list[int], times: int, lengths: np.ndarray, to: np.ndarray) -> None:
        """Puts the actual pieces into a configuration: runs of sequences in which every slot keeps its length."""
        breaks = {0, times}
        for s in slots:
            inside = to[np.searchsorted(to, s, "right") : np.searchsorted(to, s + times, "left")]
            breaks.update(int(x) - s for x in inside)
        cuts = sorted(breaks)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            offset = 0
            for s in slots:
                k = int(np.searchsorted(to, s + a, "right"))
                n = int(lengths[k])
                self.rows.append((n, s + a - (int(to[k - 1]) if k else 0), b - a, self.sequences, offset))
                offset += n
            self.room[self.capacity - offset].append((self.sequences, b - a))
            self.sequences += b - a

    def best_fit(self, n: int, count: int, number: int) -> None:
        """Pieces of one length, numbered from number on, into the least room that holds them; new sequences where none is left."""
        done = 0
        while done < count:
            room = next((r for r in range(n, self.capacity + 1) if self.room[r]), 0)
            if not room:
                more = -(-(count - done) // (self.capacity // n))
                self.room[self.capacity].append((self.sequences, more))
                self.sequences += more
                continue
            first, many = self.room[room].pop()
            if many > count - done:
                self.room[room].append((first + count - done, many - count + done))
                many = count - done
            self.rows.append((n, number + done, many, first, self.capacity - room))
            self.room[room - n].append((first, many))
            done += many

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = np.searchsorted(self.key, (length << 40) + number, "right") - 1
        return self.sequence[k] + number - self.first[k], self.offset[k]


def best_plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    return min((Plan(counts, capacity, share) for share in SMALL_SHARES), key=lambda p: p.sequences)


def packed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces (with doc_id, piece and length of at most capacity) with sequence_id and offset. pieces is read three times: store it first if it is costly."""
    plan = best_plan({r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}, capacity)  # a row for each length
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(*[c for c in pieces.columns if c != "ids"]), F.lit(partitions(pieces))))
    part = Window.partitionBy("length", "_salt")
    before = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = before.withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)))
    numbered = salted.withColumn("_number", F.row_number().over(part.orderBy("doc_id", "piece")) - 1)
    numbered = numbered.join(before.select("length", "_salt", F.coalesce("_before", F.lit(0)).alias("_before")), ["length", "_salt"])
    numbered = numbered.select(*[F.col(f"`{c}`") for c in pieces.columns], (F.col("_before") + F.col("_number")).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = plan.place(batch.column("length").to_numpy(), batch.column("sequence_id").to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(sequence), pa.array(offset)], schema=batch.schema)

    return numbered.mapInArrow(work, numbered.schema)


def packed_digests(docs: DataFrame) -> DataFrame:
    """Each piece with its place, and a checksum in place of its ids."""
    cut = pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packed(stored(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digests(table(spark, sf_dir, "documents"))
