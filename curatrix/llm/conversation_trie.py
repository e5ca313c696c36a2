"""A prefix trie of conversations: which turns they share from the first on, and what storing shared turns once would save.

Every turn is its 128-bit digest of role and text; a conversation is one row, its digests in order (20 bytes a turn: texts
are shuffled nowhere). Conversations are dealt by ranges of their digests, then of their ids, so that the members of any node
stand next to each other, and copies of one conversation are split by id like any other rows. A shard turns its digests into
turn ids and fills padded matrices of BAND columns (longer conversations go on in the next band, with the rows that
have so many turns), sorts each by numpy.lexsort, and marks a node's start where a column, or one before it, changes.
Counts, smallest members, leaves and savings of all depths come from reduceat over those starts.

Only nodes on the path of a shard's first or last conversation can have members elsewhere. Shards give partial sums for
these, at most two rows a depth; they are added up by node, and what lies below is added up along the paths: each such node
belongs to one path, and a path's suffix sums go to all its nodes. Ids that end at such a node are hashed by a task that reads
them in order, in pieces, and holds one piece at a time.

Defined results: rows without conversation id take no part; of one conversation's rows, those with a null turn come first,
those of equal turns are in the order of role, then digest; repeated rows are turns of their own; null roles and texts are
empty; a conversation without a base has no turns from it; an empty table has no node, not even a root. Very long texts count
by code points and are read once. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .blocks import flat, partitions
from .common import stored, table

#: Columns of a padded matrix.
BAND = 32
#: Ids in a piece of those that end at a node that shards share.
PIECE = 65_536
#: Turns that a base conversation lends at most, and whose base a conversation's is.
LENT, FAMILY = 6, 100
NODE, PATH, ENDS = 0, 1, 2
PARTS = "kind int, shard int, side int, slot long, parent_slot long, depth int, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, chars long, key binary, parent_key binary, ends binary"
NO_ENDS = sha256(b"").hexdigest()


def turn_lists(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order: (turn, role, digest, chars)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)
    turns = conversations.where(F.col("conv_id").isNotNull()).select("conv_id", F.struct("turn", role.alias("role"), digest.alias("digest"), F.char_length(text).alias("chars")).alias("turn"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))


def rebuilt(lists: DataFrame) -> DataFrame:
    """Every conversation c with its first h turns taken from conversation c - c % 100; h is crc32 of c's digits, modulo 6."""
    c = F.col("conv_id")
    bases = lists.where(c % FAMILY == 0).select(c.alias("_base"), F.slice("turns", 1, LENT - 1).alias("_lent"))
    h = (F.crc32(c.cast("string").cast("binary")) % LENT).cast("int")
    rows = lists.withColumns({"_of": c - c % FAMILY, "_h": h}).join(bases, F.col("_of") == F.col("_base"), "left")
    lent = F.slice(F.coalesce("_lent", F.filter("turns", lambda x: F.lit(False))), 1, F.col("_h"))
    return rows.select("conv_id", F.concat(lent, F.expr("slice(turns, _h + 1, size(turns))")).alias("turns"))


def sorted_matrix(ids: np.ndarray, at: np.ndarray, rows: np.ndarray, group: np.ndarray, lo: int) -> tuple[np.ndarray, np.ndarray]:
    """(the order of rows by group and turn ids lo to lo + BAND, their padded matrix in that order)."""
    matrix = np.full((len(rows), BAND), -1, np.int64)
    n = np.minimum(at[rows + 1] - at[rows] - lo, BAND)
    r = np.repeat(np.arange(len(rows)), n)
    c = np.arange(len(r)) - np.repeat(np.cumsum(n) - n, n)
    matrix[r, c] = ids[at[rows][r] + lo + c]
    matrix = matrix[:, : int(n.max(initial=0))]
    order = np.lexsort((*matrix.T[::-1], group))
    return order, matrix[order]


class Trie:
    """The nodes of some conversations: arrays by node, the root first, then by depth and order of turns."""

    def __init__(self, digests: np.ndarray, chars: np.ndarray, at: np.ndarray, conv_id: np.ndarray):
        n = len(conv_id)
        pair = np.ascontiguousarray(digests).view(">u8").astype(np.uint64).reshape(-1, 2)
        by_digest = np.lexsort((pair[:, 1], pair[:, 0]))
        ids = np.empty(len(pair), np.int64)
        ids[by_digest] = np.cumsum(np.diff(pair[by_digest], axis=0, prepend=0).any(axis=1))
        size = np.diff(at)
        self.conv_id, self.last = conv_id, np.zeros(n, np.int64)  # last: the node at which each conversation ends
        self.depth, self.parent, self.count, self.least, self.chars = [[0]], [[-1]], [[n]], [[conv_id.min()]], [[0]]
        rows, group = np.arange(n), np.zeros(n, np.int64)
        nodes, lo = 1, 0
        while len(rows):
            some = size[rows] > lo
            rows, group = rows[some], group[some]
            if not len(rows):
                break
            order, matrix = sorted_matrix(ids, at, rows, group, lo)
            rows, group = rows[order], group[order]
            changed = np.diff(matrix, axis=0, prepend=-2) != 0
            changed[1:, 0] |= np.diff(group) != 0
            changed[0] = True
            changed = np.logical_or.accumulate(changed, axis=1)
            for j in range(matrix.shape[1]):
                starts = np.flatnonzero(changed[:, j])
                real = matrix[starts, j] >= 0
                n_here = int(real.sum())
                if not n_here:
                    break
                counts, least = np.diff(np.append(starts, len(rows))), np.minimum.reduceat(conv_id[rows], starts)
                at_first = rows[starts[real]]
                self.depth.append(np.full(n_here, lo + j + 1))
                self.parent.append(group[starts[real]])
                self.count.append(counts[real])
                self.least.append(least[real])
                self.chars.append(chars[at[at_first] + lo + j])
                number = np.where(real, nodes + np.cumsum(real) - 1, -1)
                of_row = np.repeat(number, counts)
                group = np.where(of_row >= 0, of_row, group)
                nodes += n_here
                ended = rows[of_row >= 0]
                self.last[ended] = of_row[of_row >= 0]
            lo += BAND
        self.depth, self.parent, self.count, self.least, self.chars = (np.concatenate([np.asarray(x, np.int64) for x in v]) for v in (self.depth, self.parent, self.count, self.least, self.chars))

    def path(self, node: int) -> list[int]:
        """The nodes from the root to this one."""
        found = []
        while node >= 0:
            found.append(node)
            node = int(self.parent[node])
        return found[::-1]

    def upwards(self, own: np.ndarray) -> np.ndarray:
        """Sums of own over all subtrees, depth by depth from the deepest."""
        total = own.astype(np.int64)
        edge = np.append(np.flatnonzero(np.diff(self.depth, prepend=-1)), len(own))
        for lo, hi in zip(edge[-2:0:-1], edge[:1:-1], strict=True):
            starts = lo + np.flatnonzero(np.diff(self.parent[lo:hi], prepend=-2))
            total[self.parent[starts]] += np.add.reduceat(total[:hi], starts)
        return total


def shard_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's nodes, its parts of the nodes on its two border paths, and the ids that end at these."""
    batches = list(batches)
    rows = pa.Table.from_batches(batches) if batches else None
    if rows is None or not rows.num_rows:
        return
    digests, ends = flat(rows.column("digests"))
    chars = np.frombuffer(flat(rows.column("chars"))[0].tobytes(), ">u4").astype(np.int64)
    conv_id, shard = rows.column("conv_id").to_numpy(), rows.column("shard")[0].as_py()
    at = ends // 16
    trie = Trie(digests, chars, at, conv_id)
    n = len(trie.depth)
    lows, highs = extremes(digests, ends, conv_id)
    paths = [trie.path(int(trie.last[lows])), trie.path(int(trie.last[highs]))]
    shared = np.zeros(n, bool)
    for p in paths:
        shared[p] = True
    child = trie.parent[1:]
    n_children = np.bincount(child, minlength=n)
    inner_children = np.bincount(child[~shared[1:]], minlength=n)
    own_leaf, own_saved = (n_children == 0) & ~shared, np.where(shared, 0, (trie.count - 1) * trie.chars)
    leaves, saved = trie.upwards(own_leaf), trie.upwards(own_saved)
    # ids that end at each node, ascending
    by_node = np.lexsort((conv_id, trie.last))
    starts = np.flatnonzero(np.diff(trie.last[by_node], prepend=-1))
    stops, ended = np.append(starts[1:], len(by_node)), {}
    text = conv_id[by_node].astype("U20").tolist()
    hashes = np.full(n, NO_ENDS, object)
    for node, lo, hi in zip(trie.last[by_node[starts]].tolist(), starts.tolist(), stops.tolist(), strict=True):
        if shared[node]:
            ended[node] = (lo, hi)
        else:
            hashes[node] = sha256(",".join(text[lo:hi]).encode()).hexdigest()
    inner = np.flatnonzero(~shared)
    up = trie.parent[inner]
    open_parent = shared[up]
    yield parts(
        len(inner), kind=NODE, shard=shard, parent_slot=pa.array(up, pa.int64(), mask=~open_parent), depth=trie.depth[inner], conv_id=trie.least[inner], parent_conv_id=pa.array(trie.least[up], pa.int64(), mask=open_parent),
        n_convs=trie.count[inner], n_children=n_children[inner], n_leaves=leaves[inner], saved_tokens=saved[inner], ends=pa.array([h.encode() for h in hashes[inner]], pa.binary()),
    )
    seen: dict[int, bytes] = {}
    for side, (row, nodes) in enumerate(zip((lows, highs), paths, strict=True)):
        keys, key = [], b""
        for d in range(len(nodes)):
            key = blake2b(key + digests[ends[row] + 16 * (d - 1) : ends[row] + 16 * d].tobytes() if d else b"", digest_size=16).digest()
            keys.append(key)
        first, nodes = np.array([x not in seen for x in nodes]), np.array(nodes)
        yield parts(
            len(nodes), kind=PATH, shard=shard, side=side, slot=pa.array(nodes, pa.int64(), mask=~first), depth=trie.depth[nodes], conv_id=trie.least[nodes], n_convs=trie.count[nodes] * first, n_children=inner_children[nodes] * first,
            n_leaves=leaves[nodes] * first, saved_tokens=saved[nodes] * first, chars=trie.chars[nodes], key=pa.array(keys, pa.binary()), parent_key=pa.array([None, *keys[:-1]], pa.binary()),
        )
        seen |= dict(zip(nodes.tolist(), keys, strict=True))
    for node, (lo, hi) in ended.items():
        for k in range(lo, hi, PIECE):
            some = text[k : min(hi, k + PIECE)]
            yield parts(1, kind=ENDS, shard=shard, conv_id=np.array([int(some[0])]), key=pa.array([seen[node]], pa.binary()), ends=pa.array([",".join(some).encode()], pa.binary()))


def extremes(digests: np.ndarray, ends: np.ndarray, conv_id: np.ndarray) -> tuple[int, int]:
    """The first and the last conversation in the order of digests, then ids."""
    key = lambda r: (digests[ends[r] : ends[r + 1]].tobytes(), conv_id[r])
    return min(range(len(conv_id)), key=key), max(range(len(conv_id)), key=key)


def parts(n: int, **columns) -> pa.RecordBatch:
    """n rows of PARTS: arrays or single numbers, null where not given."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    out = {}
    for name, kind in (x.split() for x in PARTS.split(", ")):
        value = columns.get(name)
        value = np.full(n, value) if isinstance(value, int) else value
        out[name] = pa.nulls(n, kinds[kind]) if value is None else pa.array(value, kinds[kind]) if isinstance(value, np.ndarray) else value.cast(kinds[kind])
    return pa.RecordBatch.from_pydict(out)


def hashed_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each key's pieces, comma-joined; rows come by key, then first id."""
    key, state = None, None
    for batch in batches:
        for k, piece in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if k != key:
                if key is not None:
                    yield pa.RecordBatch.from_pydict({"key": pa.array([key], pa.binary()), "ends_sha256": [state.hexdigest()]})
                key, state = k, sha256()
            else:
                state.update(b",")
            state.update(piece)
    if key is not None:
        yield pa.RecordBatch.from_pydict({"key": pa.array([key], pa.binary()), "ends_sha256": [state.hexdigest()]})


def recombined(parts: DataFrame) -> DataFrame:
    """The nodes that shards may share, whole, with their keys: a row for each."""
    paths = parts.where(F.col("kind") == PATH)
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    nodes = paths.groupBy("key").agg(F.max("parent_key").alias("parent_key"), F.max("depth").alias("depth"), F.max("chars").alias("chars"), F.min("conv_id").alias("conv_id"), F.min(F.struct("shard", "side")).alias("_owner"), *sums)
    below = nodes.where(F.col("parent_key").isNotNull()).groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("_below"))
    up = nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(below, "key", "left").join(up, "parent_key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("_below", F.lit(0)))
    own = nodes.select("key", "_owner", (F.col("n_children") == 0).cast("long").alias("_leaf"), ((F.col("n_convs") - 1) * F.col("chars")).alias("_saved"))
    along = Window.partitionBy("shard", "side").orderBy(F.desc("depth"))
    mine = F.col("_owner") == F.struct("shard", "side")
    under = paths.select("key", "shard", "side", "depth").join(own, "key").select("key", *[F.sum(F.when(mine, F.col(c)).otherwise(0)).over(along).alias(c) for c in ("_leaf", "_saved")])
    under = under.groupBy("key").agg(F.sum("_leaf").alias("_leaf"), F.sum("_saved").alias("_saved"))
    pieces = parts.where(F.col("kind") == ENDS).select("key", "conv_id", "ends")
    ends = pieces.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(hashed_in_order, "key binary, ends_sha256 string")
    whole = nodes.join(under, "key").join(ends, "key", "left")
    return whole.withColumns({"n_leaves": F.col("n_leaves") + F.col("_leaf"), "saved_tokens": F.col("saved_tokens") + F.col("_saved"), "ends_sha256": F.coalesce("ends_sha256", F.lit(NO_ENDS))})


RESULTS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie_nodes(lists: DataFrame) -> DataFrame:
    """The trie's nodes of conversations with their turns in order (as turn_lists gives them), a row for each."""
    digests = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    chars = F.unhex(F.array_join(F.transform("turns", lambda t: F.lpad(F.hex(t["chars"]), 8, "0")), ""))
    rows = lists.select("conv_id", digests.alias("digests"), chars.alias("_chars"))
    rows = rows.repartitionByRange(partitions(lists), "digests", "conv_id").withColumn("shard", F.spark_partition_id())
    found = stored(rows.withColumnRenamed("_chars", "chars").mapInArrow(shard_parts, PARTS))
    shared = stored(recombined(found))
    slots = found.where((F.col("kind") == PATH) & F.col("slot").isNotNull()).select("shard", F.col("slot").alias("parent_slot"), "key").join(shared.select("key", F.col("conv_id").alias("_parent")), "key").drop("key")
    inner = found.where(F.col("kind") == NODE).withColumn("ends_sha256", F.col("ends").cast("string"))
    under_shared = inner.where(F.col("parent_slot").isNotNull()).join(slots, ["shard", "parent_slot"], "left").withColumn("parent_conv_id", F.col("_parent"))
    pick = lambda df: df.select(*[F.col(c).cast("string" if c == "ends_sha256" else "long").alias(c) for c in RESULTS])
    return pick(inner.where(F.col("parent_slot").isNull())).unionByName(pick(under_shared)).unionByName(pick(shared))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_nodes(rebuilt(turn_lists(table(spark, sf_dir, "conversations"))))


#: crc32 of a number's digits: a table of 256 entries from the polynomial, then byte by byte.
OP12_SQL = f"""
WITH crcs AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS crc FROM (SELECT unnest(range(256)) AS i)),
turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))[1:32] AS digest FROM conversations WHERE conv_id IS NOT NULL),
lists AS (SELECT conv_id, list(struct_pack(digest := digest, chars := length(text)) ORDER BY turn NULLS FIRST, role, digest) AS ts FROM turns GROUP BY 1),
h AS (SELECT conv_id, ts, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1])), 4294967295) % {LENT} AS h FROM lists, crcs),
r AS (SELECT h.conv_id, list_concat(coalesce(b.ts, [])[1:h], h.ts[h + 1:]) AS ts FROM h LEFT JOIN lists b ON b.conv_id = h.conv_id - h.conv_id % {FAMILY}),
p AS (SELECT conv_id, len(ts) AS n, d, sha256(list_aggregate(list_prepend('', list_transform(ts[1:d], lambda x: x.digest)), 'string_agg', ',')) AS k, CASE WHEN d > 0 THEN sha256(list_aggregate(list_prepend('', list_transform(ts[1:d - 1], lambda x: x.digest)), 'string_agg', ',')) END AS pk,
  CASE WHEN d > 0 THEN ts[d].chars ELSE 0 END AS chars FROM (SELECT *, unnest(range(len(ts) + 1)) AS d FROM r)),
nodes AS (SELECT k, d, any_value(pk) AS pk, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '') AS ends FROM p GROUP BY 1, 2),
kids AS (SELECT pk AS k, count(*) AS n FROM nodes WHERE pk IS NOT NULL GROUP BY 1),
whole AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids USING (k)),
pairs AS (SELECT DISTINCT a.k AS top, b.k AS k FROM p a JOIN p b ON a.conv_id = b.conv_id AND a.d <= b.d),
sums AS (SELECT top AS k, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * chars) AS saved FROM pairs JOIN whole USING (k) GROUP BY 1)
SELECT w.conv_id, w.d AS depth, u.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved::BIGINT AS saved_tokens, sha256(w.ends) AS ends_sha256 FROM whole w JOIN sums ON w.k = sums.k LEFT JOIN whole u ON w.pk = u.k
"""
