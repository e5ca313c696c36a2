"""Byte-level BPE over overlapping chunks, and decoding.

A text of up to CHUNK characters is one piece. Longer ones are cut into chunks that reach OVERLAP characters into the
next; all chunks are pre-tokenised in parallel. Where a chunk and the next both start a pre-token at the same character
of the overlap, they agree from there on, as the pattern looks ahead only: that is the seam, if no white space is before
it (at a piece's end the pattern would take a run of white space whole, which it leaves a character of before other text). The pieces between
seams are encoded on their own, also in parallel, and their ids joined in order. A text with an overlap where they
never agree (a pre-token longer than the overlap) is encoded in one piece. Decoding joins the bytes of the ids.

Defined results: a null text is empty and has no ids; strings of special tokens are ordinary text; repeated rows, and
rows with the same or no id, come out once each; other columns than id and text are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table
from .encoders import rank_file

CHUNK, OVERLAP = 32_768, 512
SLICE = 256
#: Characters before a chunk's end where the pattern might match otherwise with more text: its longest alternative of fixed letters.
MARGIN = 4


@lru_cache(maxsize=1)
def pattern():
    return regex.compile(public_tokenizers.PATTERN)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of SLICE rows: what is made of one is held while the next is made, on both sides of the pipe."""
    for batch in batches:
        for lo in range(0, max(len(batch), 1), SLICE):
            yield batch.slice(lo, SLICE)


def chunked(docs: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(id, key, chunk, chunks, body) of the texts over one chunk. key: the same for all chunks of a text."""
    size = F.char_length("text")
    rows = docs.where(size > chunk).select("id", F.xxhash64("id", "text").alias("key"), "text", F.ceil(size / chunk).cast("int").alias("chunks"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    return rows.select("id", "key", "chunk", "chunks", F.expr(f"substring(text, chunk * {chunk} + 1, {chunk + overlap})").alias("body"))


def boundaries(chunks: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(key, chunk, chunks, head, tail): the pre-token starts in a chunk's first characters, and those in its overlap with the next, both from where the overlap begins."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            heads, tails = [], []
            for body in batch.column("body"):
                text = body.as_py()
                starts = np.array([m.start() for m in pattern().finditer(text)], np.int32)
                heads.append(starts[starts < overlap])
                after = starts[(starts >= chunk) & (starts <= len(text) - MARGIN)]
                tails.append(np.array([k for k in after.tolist() if not text[k - 1].isspace()], np.int32) - chunk)
            lists = [pa.array(x, pa.list_(pa.int32())) for x in (heads, tails)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "chunk", "chunks")), *lists], ["key", "chunk", "chunks", "head", "tail"])

    return chunks.select("key", "chunk", "chunks", "body").mapInArrow(work, "key long, chunk int, chunks int, head array<int>, tail array<int>")


def seams(found: DataFrame) -> DataFrame:
    """(key, chunk, first, last, whole): the piece that begins in each chunk, from its first character to where the next begins; whole: a seam of the text is missing."""
    found = found.dropDuplicates(["key", "chunk"])  # of repeated rows
    text = Window.partitionBy("key")
    seam = F.array_min(F.array_intersect("tail", F.lead("head").over(text.orderBy("chunk"))))
    rows = found.withColumn("_seam", seam).withColumn("_before", F.lag("_seam").over(text.orderBy("chunk")))
    rows = rows.withColumn("whole", F.max(F.col("_seam").isNull() & (F.col("chunk") < F.col("chunks") - 1)).over(text))
    return rows.select("key", "chunk", F.coalesce("_before", F.lit(0)).alias("first"), "_seam", "whole")


def encoded(rows: DataFrame, ranks: str) -> DataFrame:
    """rows with ids in place of body; the other columns stay."""
    kept = [c for c in rows.columns if c != "body"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = rank_file(ranks)
        for batch in slices(batches):
            ids = [np.array(encoder.encode_ordinary(x.as_py() or ""), "<u4").tobytes() for x in batch.column("body")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(ids, pa.binary())], [*kept, "ids"])

    schema = rows.select(*kept, F.lit(b"").cast("binary").alias("ids")).schema
    return rows.mapInArrow(work, schema)


def encode_documents(docs: DataFrame, ranks: str, id_column: str = "doc_id", text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(id, ids) of every row; ids are little-endian unsigned 32-bit numbers."""
    docs = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    short = docs.where(F.char_length("text") <= chunk).select("id", F.col("text").alias("body"))
    chunks = chunked(docs, chunk, overlap)
    cuts = seams(boundaries(chunks, chunk, overlap))
    split = cuts.where(~F.col("whole")).drop("whole").withColumnsRenamed({"key": "_key", "chunk": "_chunk"})
    pieces = chunks.join(split, (F.col("key") == F.col("_key")) & (F.col("chunk") == F.col("_chunk")))
    last = F.coalesce(F.col("_seam") + chunk, F.lit(chunk + overlap))
    pieces = encoded(pieces.select("id", "key", "chunk", F.substring("body", F.col("first") + 1, last - F.col("first")).alias("body")), ranks)
    joined = pieces.groupBy("id", "key").agg(F.sort_array(F.collect_set(F.struct("chunk", "ids"))).alias("parts"), F.sum((F.col("chunk") == 0).cast("int")).alias("copies"))
    joined = joined.select("id", joined_ids(F.col("parts")).alias("ids"), F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("col")
    odd = cuts.where("whole").select(F.col("key").alias("_key")).distinct()
    uncut = docs.where(F.char_length("text") > chunk).withColumn("key", F.xxhash64("id", "text")).join(odd, F.col("key") == F.col("_key"), "left_semi")
    return encoded(short.unionByName(uncut.select("id", F.col("text").alias("body"))), ranks).unionByName(joined)


def joined_ids(parts: Column) -> Column:
    return F.unhex(F.array_join(F.transform(parts, lambda p: F.hex(p["ids"])), ""))


def decode_documents(coded: DataFrame, ranks: str) -> DataFrame:
    """coded (with ids) with decoded: the bytes of the ids one after the other."""
    kept = coded.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = rank_file(ranks)
        for batch in slices(batches):
            out = [decoder.decode_bytes(np.frombuffer(x.as_py(), "<u4").tolist()) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*kept, "decoded"])

    return coded.mapInArrow(work, coded.select("*", F.lit(b"").cast("binary").alias("decoded")).schema)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    both = decode_documents(encode_documents(table(spark, sf_dir, "documents"), ranks), ranks)
    return both.select(F.col("id").alias("doc_id"), (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
