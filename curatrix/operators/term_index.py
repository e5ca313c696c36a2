"""An inverted index of letter groups, so that a term search reads posting lists and the parts of the table that have hits.

Under `path` lie `rows` (the table with its search texts, a folder for each part by a hash of the id), `postings` (gram, id, part; sorted by gram
over all files, so that Parquet's statistics leave out all but a gram's own row groups) `counts` (how many rows have each gram) and `schema` (no rows).
A term lies within one word of a search text, so a word's groups of two and three characters are enough to find it. Two rare ones of each term are
looked up; the rows that have all of them are then searched as a scan would.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import BLANKS, search_text
from ..sources.session import written
from .rows import search_terms, vibe_search

#: Lengths of the groups; the first serves terms that are no longer.
SIZES = (2, 3)
#: Groups looked up for each term, the rarest.
LOOKED_UP = 2


def grams(texts: list[Column]) -> Column:
    """The distinct groups of the words of search texts."""
    words = F.array_distinct(F.filter(F.flatten(F.array(*[F.split(t, rf"(?U)[{BLANKS}.,-]+") for t in texts])), lambda w: w != ""))

    def of_size(letters: Column, n: int) -> Column:
        several = F.transform(F.sequence(F.lit(0), F.greatest(F.size(letters) - n, F.lit(0))), lambda i: F.concat(*[F.get(letters, i + k) for k in range(n)]))
        return F.when(F.size(letters) >= n, several).otherwise(F.array().cast("array<string>"))

    spelled = F.transform(words, lambda w: F.split(w, ""))  # spelled once a word, not once a group
    return F.array_distinct(F.flatten(F.transform(spelled, lambda w: F.array_distinct(F.concat(*[of_size(w, n) for n in SIZES])))))


def build(df: DataFrame, path: str, row_id: str, columns: list[str], parts: int | None = None) -> None:
    """Writes the index of df. Ids may repeat or be null. A group that most rows have is as many rows of postings, in as many files as they fill."""
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.withColumns({f"_search_{c}": search_text(F.col(c)) for c in columns}).withColumn("_part", F.pmod(F.xxhash64(row_id), F.lit(parts)).cast("int"))
    rows.repartition(parts, "_part").write.partitionBy("_part").parquet(f"{path}/rows")
    rows.limit(0).write.parquet(f"{path}/schema")  # a table without rows has no part
    stored = spark.read.schema(rows.schema).parquet(f"{path}/rows")
    postings = stored.select(F.explode(grams([F.col(f"_search_{c}") for c in columns])).alias("gram"), F.col(row_id).alias("_id"), "_part")
    postings.repartitionByRange("gram", "_part", "_id").sortWithinPartitions("gram", "_part", "_id").write.parquet(f"{path}/postings")
    spark.read.schema(postings.schema).parquet(f"{path}/postings").groupBy("gram").count().repartitionByRange("gram").sortWithinPartitions("gram").write.parquet(f"{path}/counts")


def looked_up(spark: SparkSession, path: str, terms: list[str]) -> list[str] | None:
    """The groups to look up for terms, or None if no row has one of them."""
    of = {t: {t[k : k + n] for n in [min(len(t), SIZES[-1])] for k in range(len(t) - n + 1)} for t in terms}
    every = sorted(set().union(*of.values()))
    known = {r["gram"]: r["count"] for r in spark.read.schema("gram string, count bigint").parquet(f"{path}/counts").where(F.col("gram").isin(every)).collect()}  # at most as many as the query has letters
    if len(known) < len(every):
        return None
    return sorted({g for t in terms for g in sorted(of[t], key=lambda g: (known[g], g))[:LOOKED_UP]})


def search(spark: SparkSession, path: str, query: str, row_id: str, columns: list[str]) -> DataFrame:
    """The rows that rows.vibe_search finds in the table, from the index alone."""
    rows = spark.read.schema(spark.read.parquet(f"{path}/schema").schema).parquet(f"{path}/rows")
    kept = [c for c in rows.columns if c != "_part" and c not in {f"_search_{x}" for x in columns}]
    terms = search_terms(query)
    if not terms:
        return rows.select(*kept)
    wanted = looked_up(spark, path, terms)
    if wanted is None:
        return rows.where(F.lit(False)).select(*kept)
    place = reduce(lambda a, k: F.when(F.col("gram") == wanted[k], 1 << k).otherwise(a), range(len(wanted)), F.lit(0))
    postings = spark.read.parquet(f"{path}/postings").where(F.col("gram").isin(wanted))
    hits = postings.groupBy("_part", "_id").agg(F.bit_or(place).alias("_found")).where(F.col("_found") == (1 << len(wanted)) - 1).drop("_found")
    hits = written(hits.withColumnRenamed("_part", "_p"))
    parts = [r["_p"] for r in hits.select("_p").distinct().collect()]  # at most as many as the index has parts
    found = rows.where(F.col("_part").isin(parts)).join(hits, (F.col("_part") == F.col("_p")) & F.col(row_id).eqNullSafe(F.col("_id")), "left_semi")
    for c in columns:  # the search texts stand for their columns
        found = found.withColumn(f"_kept_{c}", F.col(c)).withColumn(c, F.col(f"_search_{c}"))
    found = vibe_search(found, query, columns, prepared=True)
    return found.select(*[F.col(f"_kept_{c}").alias(c) if c in columns else F.col(c) for c in kept])
