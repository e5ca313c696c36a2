"""Hard negatives: for an anchor and each of its nearest rows of the same label, the nearest rows of other labels in a window of scores.

A vertical scan. Rows are dealt into blocks by a hash of their id; a task holds one block column by column and reads its
anchors one after the other, so that memory is that of a block and a batch of anchors. For each anchor the block's columns are read
in descending order of the anchor's components by magnitude, STEP at a time. What the unread columns can still add lies between sums of their
least and greatest products (each column's least and greatest value is known). A bitmap holds the candidates; those whose
range cannot reach the FOUND best any more, or whose range misses every window, leave it, and the rest is read on until
scores are exact. Two scans: rows of the anchor's own label give its positives, then rows of other labels are scanned with the
windows known. A block sends FOUND rows at most for an anchor, or for one of its windows, and these are ranked by anchor.

Scores are exact integers: sums are made in single or double precision only where a bound of the block proves them
exact, else as Python's integers; a score beyond 64 bits is the nearest that fits.

Defined results: rows with a null label, vector or component, or one that is not finite, take no part, nor do rows without
id; components that a vector lacks beside a longer one count as zero, so vectors of any lengths, empty ones too, have a score; repeated rows
are rows of their own, but an anchor that repeats is one anchor, and rows with its id are none of its positives; ties go to
the smaller id. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .blocks import partitions
from .common import stored, table

#: Positives of an anchor, and negatives of each.
FOUND = 5
#: A component x becomes floor(SCALE * x).
SCALE = 256
#: Columns that are read between two looks at the bitmap.
STEP = 8
#: Rows of a block at most, on average.
BLOCK_ROWS = 200_000
LONG = np.iinfo(np.int64)
HITS = "anchor long, anchor_id long, slot int, positive_id long, positive_score long, score long, vec_id long"


def comparable(rows: DataFrame, label: Column) -> DataFrame:
    """vec_id, label, vector: the rows that take part."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & label.isNotNull() & F.col("embedding").isNotNull() & whole).select("vec_id", label.cast("int").alias("label"), F.col("embedding").cast("array<double>").alias("vector"))


def anchors_of(rows: DataFrame, every: int) -> DataFrame:
    """Each distinct row whose id is divisible by every, with a key of its own: anchor."""
    return rows.where(F.col("vec_id") % every == 0).distinct().withColumn("anchor", F.xxhash64("vec_id", "label", "vector"))


class Block:
    """Vectors column by column, as integers, by label."""

    def __init__(self, vec_id: np.ndarray, label: np.ndarray, vectors: np.ndarray):
        order = np.argsort(label, kind="stable")
        self.vec_id, self.label = vec_id[order], label[order]
        self.columns = np.ascontiguousarray(vectors[order].T)
        self.low, self.high = (f(self.columns, axis=1) if self.columns.size else np.zeros(len(self.columns)) for f in (np.min, np.max))
        self.largest = float(np.abs(self.columns).max(initial=0))
        self.single = self.columns.astype(np.float32) if self.largest < 1 << 24 else None

    def labelled(self, label: int, same: bool) -> np.ndarray:
        """The bitmap, as positions, of rows with this label, or of all others."""
        lo, hi = np.searchsorted(self.label, [label, label + 1])
        return np.arange(lo, hi) if same else np.concatenate([np.arange(lo), np.arange(hi, len(self.label))])

    def scan(self, anchor: np.ndarray, rows: np.ndarray, still) -> tuple[np.ndarray, np.ndarray]:
        """(the rows that still lets stay, their exact scores); still(low, high) tells which rows' ranges may yet count."""
        n = min(len(anchor), len(self.columns))
        anchor = anchor[:n]
        order = np.argsort(-np.abs(anchor), kind="stable")
        order = order[anchor[order] != 0]
        bound = float(n) * float(np.abs(anchor).max(initial=0)) * self.largest
        columns, kind = (self.single, np.float32) if bound < 1 << 24 and self.single is not None else (self.columns, np.float64)
        if bound >= 1 << 53:
            return self.in_integers(anchor, rows)
        a, low, high = anchor[order], self.low[order], self.high[order]
        least, most = (np.append(np.cumsum(f(a * low, a * high)[::-1])[::-1], 0) for f in (np.minimum, np.maximum))
        score, whole = np.zeros(len(rows), kind), len(rows) == len(self.vec_id)
        for k in range(0, len(order), STEP):
            some = order[k : k + STEP]
            score += a[k : k + STEP].astype(kind) @ (columns[some] if whole else columns[some][:, rows])
            stay = still(score + least[min(k + STEP, len(a))], score + most[min(k + STEP, len(a))])
            if not stay.all():
                rows, score, whole = rows[stay], score[stay], False
            if not len(rows):
                break
        return rows, score.astype(np.int64)

    def in_integers(self, anchor: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        whole = [int(x) for x in anchor]
        scores = [sum(x * int(y) for x, y in zip(whole, self.columns[: len(whole), r], strict=True)) for r in rows]
        return rows, np.array([min(max(s, -LONG.max), LONG.max) for s in scores], np.int64)


def best(score: np.ndarray, vec_id: np.ndarray, n: int = FOUND) -> np.ndarray:
    """Positions of the n best, ties by smaller id."""
    if len(score) > 4 * n:
        some = np.flatnonzero(score >= np.partition(score, len(score) - n)[len(score) - n])
        return some[np.lexsort((vec_id[some], -score[some]))[:n]]
    return np.lexsort((vec_id, -score))[:n]


def kth(values: np.ndarray, n: int = FOUND) -> float:
    """The n-th largest (none: below all)."""
    return np.partition(values, len(values) - n)[len(values) - n] if len(values) >= n else -np.inf


def positives_in(block: Block, anchor_id: int, label: int, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scores, ids) of the block's best rows of the anchor's label."""
    rows = block.labelled(label, True)
    rows, score = block.scan(vector, rows[block.vec_id[rows] != anchor_id], lambda low, high: high >= kth(low))
    top = best(score, block.vec_id[rows])
    return score[top], block.vec_id[rows[top]]


def negatives_in(block: Block, label: int, vector: np.ndarray, tops: list[int]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For the distinct window ends in tops, with their places: (place, scores, ids) of the best rows of other labels in its window."""
    windows = [(k, p) for k, p in enumerate(tops) if p >= 0]
    if not windows:
        return []
    bottoms = {p: -(-4 * p // 5) for _, p in windows}  # 80 * p <= 100 * score

    def still(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        stay = np.zeros(len(low), bool)
        for p, bottom in bottoms.items():
            stay |= (low <= p) & (high >= max(bottom, kth(low[(low >= bottom) & (high <= p)])))
        return stay

    rows, score = block.scan(vector, block.labelled(label, False), still)
    found = []
    for k, p in windows:
        inside = np.flatnonzero((score >= bottoms[p]) & (score <= p))
        top = inside[best(score[inside], block.vec_id[rows[inside]])]
        found.append((k, score[top], block.vec_id[rows[top]]))
    return found


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """The vectors as integers, shorter ones filled with zeros."""
    lists = column.combine_chunks()
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    size = np.diff(lists.offsets.to_numpy())
    values = np.floor(lists.flatten().to_numpy(zero_copy_only=False) * SCALE)
    out = np.zeros((len(size), int(size.max(initial=0))))
    r = np.repeat(np.arange(len(size)), size)
    out[r, np.arange(len(r)) - np.repeat(np.cumsum(size) - size, size)] = values
    return out


def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best rows of each block for each anchor that follows it: blocks come one after the other, rows before anchors."""
    number, parts, block = None, [], None
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        edge = [*np.flatnonzero(np.diff(blocks, prepend=-1)).tolist(), len(blocks)]
        for lo, hi in zip(edge, edge[1:], strict=False):
            t = pa.Table.from_batches([batch.slice(lo, hi - lo)])
            if blocks[lo] != number:
                number, parts, block = blocks[lo], [], None
            is_anchor = t.column("anchor").is_valid()
            rows, anchors = t.filter(pc.invert(is_anchor)), t.filter(is_anchor)
            if rows.num_rows:
                parts.append(rows.select(["vec_id", "label", "vector"]))
            if anchors.num_rows and block is None and parts:
                t = pa.concat_tables(parts)
                parts, block = [], Block(t.column("vec_id").to_numpy(), t.column("label").to_numpy(), matrix(t.column("vector")))
            if anchors.num_rows and block is not None:
                yield hits(block, anchors)


def hits(block: Block, anchors: pa.Table) -> pa.RecordBatch:
    """HITS of a block for some anchors."""
    out: list[tuple] = []
    vectors = matrix(anchors.column("vector"))
    keys, ids, labels, found = (anchors.column(c).to_pylist() for c in ("anchor", "vec_id", "label", "positives"))
    for i in range(len(keys)):
        if found[i] is None:
            score, vec_id = positives_in(block, ids[i], labels[i], vectors[i])
            out += [(keys[i], ids[i], 0, None, None, s, v) for s, v in zip(score.tolist(), vec_id.tolist(), strict=True)]
        else:
            tops = [p["score"] for p in found[i]]
            for k, score, vec_id in negatives_in(block, labels[i], vectors[i], tops):
                out += [(keys[i], ids[i], k, found[i][k]["vec_id"], tops[k], s, v) for s, v in zip(score.tolist(), vec_id.tolist(), strict=True)]
    names, kinds = zip(*(x.split() for x in HITS.split(", ")), strict=True)
    columns = list(zip(*out, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_pydict({n: pa.array(c, pa.int32() if k == "int" else pa.int64()) for n, k, c in zip(names, kinds, columns, strict=True)})


def vertical_scan(rows: DataFrame, anchors: DataFrame, n: int) -> DataFrame:
    """HITS of each block of rows for each anchor. anchors: anchor, vec_id, label, vector, positives (null: these are sought)."""
    rows = rows.withColumns({"block": F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int"), "anchor": F.lit(None).cast("long"), "positives": F.lit(None).cast("array<struct<vec_id:bigint,score:bigint>>")})
    copies = anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    both = rows.unionByName(copies).repartitionById(n, "block").sortWithinPartitions("block", F.asc_nulls_first("anchor"))
    return both.mapInArrow(scanned, HITS)


def ranked(hits: DataFrame, *by: str) -> DataFrame:
    """The FOUND best hits of a group, with rank."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= FOUND)


def hard_negatives(rows: DataFrame, label: Column | str = "label", every: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for each anchor: a row whose vec_id is divisible by every."""
    rows = comparable(rows, F.col(label) if isinstance(label, str) else label)
    n = max(partitions(rows), -(-rows.count() // BLOCK_ROWS))
    anchors = anchors_of(rows, every)
    none = F.lit(None).cast("array<struct<vec_id:bigint,score:bigint>>")
    near = ranked(vertical_scan(rows, anchors.withColumn("positives", none), n), "anchor", "anchor_id")
    positives = near.groupBy("anchor", F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("found"))
    positives = positives.select("anchor", "vec_id", F.transform("found", lambda x: F.struct(x["vec_id"].alias("vec_id"), x["score"].alias("score"))).alias("positives"))  # FOUND at most
    with_windows = stored(anchors.join(positives, ["anchor", "vec_id"]))
    hits = ranked(vertical_scan(rows, with_windows, n), "anchor", "anchor_id", "slot")
    return hits.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), label)


OP13_SQL = f"""
WITH t AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score FROM t a JOIN t b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {FOUND}),
n AS (SELECT anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id))::INTEGER AS rank, negative_id, positive_score, negative_score FROM n
  QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id) <= {FOUND}
"""
