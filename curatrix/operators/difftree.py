"""Differences of two versions of a table from trees of digests: only key ranges whose digests differ are read.

A version is written once, its rows in order of a 64-bit hash of their key, with a digest of each range of hashes: how many rows and keys it
has and two sums of row hashes. Ranges form a tree of 2^BITS children a node down to about LEAF_ROWS rows a leaf. Two versions are compared from
the root: children are read of nodes that differ only, so equal tables cost one row each, and the work follows the difference. In the leaves that differ
only key and row hashes are read first; whole rows are fetched for the keys among them whose rows differ. A key that many rows share lies
in one leaf, and its rows are counted by partial sums, never held together.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.session import written

BITS, LEAF_ROWS, MAX_LEVELS = 6, 64, 7
#: Up to so many leaves are pushed to the scan as ranges of hashes; beyond, leaves are joined.
PUSHED = 64
SUM = "decimal(38,0)"
DIGESTS = f"node long, n long, n_keys long, n_once long, _h1 {SUM}, _h2 {SUM}, level int"


def node(key: Column, level: int) -> Column:
    """The node of a level that a key's hash lies in: the hash's first bits."""
    return F.shiftrightunsigned(key, 64 - BITS * level) if level else F.lit(0).cast("long")


class Tree:
    """A written version and its digests."""

    def __init__(self, spark: SparkSession, root: str):
        about = json.loads(spark.read.text(f"{root}/about", wholetext=True).first()[0])
        self.keys, self.levels = about["keys"], about["levels"]
        self.all_rows, self.digests = spark.read.parquet(f"{root}/rows"), spark.read.schema(DIGESTS).parquet(f"{root}/digests")
        self.columns = [c for c in self.all_rows.columns if c not in ("_key", "_h1", "_h2")]

    @staticmethod
    def write(df: DataFrame, keys: list[str], root: str, leaf_rows: int = LEAF_ROWS) -> Tree:
        """df as a version with its tree under root."""
        spark = df.sparkSession
        whole = sorted(df.columns)
        rows = df.withColumns({"_key": F.xxhash64(*keys), "_h1": F.xxhash64(*whole), "_h2": F.xxhash64(F.lit("2"), *whole)})
        rows.repartitionByRange("_key", "_h1").sortWithinPartitions("_key").write.parquet(f"{root}/rows")
        rows = spark.read.parquet(f"{root}/rows")
        levels, total = 0, rows.count()
        while levels < MAX_LEVELS and total > leaf_rows << BITS * levels:
            levels += 1
        by_key = rows.groupBy("_key", *keys).agg(F.count("*").alias("n"), *[F.sum(F.col(h).cast(SUM)).cast(SUM).alias(h) for h in ("_h1", "_h2")])
        sums = [F.sum("n").alias("n"), F.sum("n_keys").alias("n_keys"), F.sum("n_once").alias("n_once"), *[F.sum(h).cast(SUM).alias(h) for h in ("_h1", "_h2")]]
        at = written(by_key.select(node(F.col("_key"), levels).alias("node"), "n", F.lit(1).alias("n_keys"), (F.col("n") == 1).cast("int").alias("n_once"), "_h1", "_h2").groupBy("node").agg(*sums))
        for level in range(levels, -1, -1):
            at.withColumn("level", F.lit(level)).write.mode("append").partitionBy("level").parquet(f"{root}/digests")
            at = at.withColumn("node", F.shiftrightunsigned("node", BITS)).groupBy("node").agg(*sums)
        spark.createDataFrame([(json.dumps({"keys": keys, "levels": levels}),)], "value string").coalesce(1).write.text(f"{root}/about")
        return Tree(spark, root)

    def level(self, k: int) -> DataFrame:
        return self.digests.where(F.col("level") == k).drop("level")

    def rows_in(self, leaves: DataFrame, level: int, *columns: str) -> DataFrame:
        """These columns of the rows in leaves of a level, which Parquet's own ranges of hashes select where they are few."""
        rows = self.all_rows
        few = [r["node"] for r in leaves.limit(PUSHED + 1).collect()]
        if len(few) > PUSHED:
            return rows.withColumn("node", node(F.col("_key"), level)).join(leaves.select("node"), "node", "left_semi").select(*columns)
        if not level:
            return rows.select(*columns).where(F.lit(bool(few)))
        step, within = 1 << 64 - BITS * level, F.lit(False)
        for n in few:
            low = n * step
            low -= (1 << 64) * (low >= 1 << 63)  # as signed hashes
            within |= F.col("_key").between(low, low + step - 1)
        return rows.where(within).select(*columns)


class Difference:
    """What differs between two trees of one key."""

    def __init__(self, left: Tree, right: Tree):
        if left.keys != right.keys or left.columns != right.columns:
            raise ValueError("the versions have other keys or columns")
        self.left, self.right, self.keys = left, right, left.keys
        self.level = min(left.levels, right.levels)
        self.compared = []  # how many nodes of each level were read
        differ = None
        for k in range(self.level + 1):
            a, b = (self.children(t, k, differ) for t in (left, right))
            names = ["n", "_h1", "_h2"]
            both = a.select("node", F.struct(*names).alias("a")).join(b.select("node", F.struct(*names).alias("b")), "node", "full_outer")
            both = written(both)
            self.compared.append(both.count())
            differ = written(both.where(~F.col("a").eqNullSafe(F.col("b"))).select("node"))
            if differ.isEmpty():
                self.level = k
                break
        self.leaves = differ
        hashes = [written(t.rows_in(differ, self.level, "_key", "_h1", "_h2")) for t in (left, right)]
        self.hashes_read = sum(h.count() for h in hashes)
        count = lambda h, s: h.groupBy("_key", "_h1", "_h2").agg(F.sum(F.lit(s)).alias("n"))
        both = count(hashes[0], 1).unionByName(count(hashes[1], -1)).groupBy("_key", "_h1", "_h2").agg(F.sum("n").alias("n"))
        self.changed = written(both.where("n <> 0").select("_key").distinct())

    @staticmethod
    def children(tree: Tree, level: int, parents: DataFrame | None) -> DataFrame:
        nodes = tree.level(level)
        return nodes if parents is None else nodes.withColumn("_up", F.shiftrightunsigned("node", BITS)).join(parents.select(F.col("node").alias("_up")), "_up", "left_semi").drop("_up")

    def rows(self) -> tuple[DataFrame, DataFrame]:
        """All rows, of both sides, of the keys whose rows differ."""
        return tuple(t.rows_in(self.leaves, self.level, *t.columns, "_key").join(self.changed, "_key", "left_semi").drop("_key") for t in (self.left, self.right))

    def census(self) -> DataFrame:
        """versions.key_census of the whole tables: from digests where they are equal, from keys elsewhere."""
        same = self.left.level(self.level).join(self.leaves, "node", "left_anti").agg(F.coalesce(F.sum("n_keys"), F.lit(0)).alias("_keys"), F.coalesce(F.sum("n_once"), F.lit(0)).alias("_once"))
        sizes = [t.rows_in(self.leaves, self.level, *self.keys).groupBy(*self.keys).agg(F.count("*").alias("n")) for t in (self.left, self.right)]
        side = lambda s, p: s.select(*self.keys, F.struct(F.lit(p).alias("side"), "n").alias("s"))
        both = side(sizes[0], "l").unionByName(side(sizes[1], "r")).groupBy(*self.keys).agg(*[F.sum(F.when(F.col("s.side") == p, F.col("s.n"))).alias(p) for p in "lr"])
        on = both.agg(F.count("l").alias("left_keys"), F.count("r").alias("right_keys"), F.count_if(F.col("l").isNotNull() & F.col("r").isNotNull()).alias("shared"), F.count_if((F.col("l") == 1) & (F.col("r") == 1)).alias("unambiguous"), F.count_if(F.col("r").isNull()).alias("only_left"), F.count_if(F.col("l").isNull()).alias("only_right"))
        more = lambda c, x: (F.col(c) + F.col(x)).alias(c)
        return on.crossJoin(F.broadcast(same)).select(*[more(c, "_keys") for c in ("left_keys", "right_keys", "shared")], more("unambiguous", "_once"), "only_left", "only_right")  # one row each
