"""URL rules in a sorted digest array.

A rule is `host/path`: it fits its host and all subdomains of it where the url's path begins with `/path`; the longest
rule that fits decides. Rules are kept as a sorted array of 64-bit xxhash digests of their texts beside the texts
themselves, in one file that goes to every executor once (as SparkFiles do) and is memory-mapped there. For each url the
digests of all its host suffixes with all beginnings of its path that are as long as some rule's path are looked up by
vectorised binary search, and a hit counts only if the stored text is equal, so that colliding digests do no harm.

A list is limited to MAX_RULES_BYTES of text, as every executor holds it on disk (pages of it in memory as they are
read). A url that no rule fits is allowed by default, but blocked if it has no host, as nothing can be fetched from it.

Defined results: null urls and urls without `://` have an empty host and path, no rule, and are blocked; upper-case
hosts are lower-cased (A-Z); rows come out once each, repeated ones too; other columns pass through unless a result column has their name.
"""

from __future__ import annotations

import hashlib
import mmap
import os
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import table

MAX_RULES_BYTES = 1 << 30
#: The rules of the query.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
SEED = 0


def digests(texts: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(t, seed=SEED) for t in texts], np.uint64)


def write_rules(rules: dict[str, str], path: str) -> None:
    """The array's file: number of rules, of path lengths, digests in order, offsets of the texts, verdicts, path lengths, texts."""
    texts = [k.encode() for k in rules]
    if sum(map(len, texts)) > MAX_RULES_BYTES:
        raise ValueError(f"rules exceed {MAX_RULES_BYTES} bytes of text")
    keys = digests(texts)
    order = np.argsort(keys, kind="stable")
    texts = [texts[i] for i in order]
    verdicts = np.array([list(rules.values())[i] == "block" for i in order], np.uint8)
    lengths = sorted({len(k.partition("/")[2].encode()) + 1 for k in rules})
    offsets = np.cumsum([0, *map(len, texts)])
    with open(path, "wb") as out:
        for part in (np.array([len(texts), len(lengths)]), keys[order], offsets, np.array(lengths)):
            out.write(part.astype("<u8").tobytes())
        out.write(verdicts.tobytes() + b"".join(texts))


class RuleArray:
    """The mapped file."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        n, m = (int(x) for x in np.frombuffer(self.map, "<u8", 2))
        self.keys = np.frombuffer(self.map, "<u8", n, 16)
        self.offsets = np.frombuffer(self.map, "<u8", n + 1, 16 + 8 * n)
        self.lengths = np.frombuffer(self.map, "<u8", m, 24 + 16 * n).astype(int).tolist()
        self.block = np.frombuffer(self.map, np.uint8, n, 24 + 16 * n + 8 * m)
        self.texts = 24 + 17 * n + 8 * m

    def text(self, k: int) -> bytes:
        return self.map[self.texts + int(self.offsets[k]) : self.texts + int(self.offsets[k + 1])]

    def find(self, wanted: list[bytes]) -> np.ndarray:
        """Each text's place in the array, -1 if it is no rule."""
        if not len(self.keys) or not wanted:
            return np.full(len(wanted), -1)
        own = digests(wanted)
        at = np.searchsorted(self.keys, own)
        hits = np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] == own)
        out = np.full(len(wanted), -1)
        for i in hits:
            k = int(at[i])
            while k < len(self.keys) and self.keys[k] == own[i]:  # equal digests stand together
                if self.text(k) == wanted[i]:
                    out[i] = k
                    break
                k += 1
        return out

    def candidates(self, host: str, path: str) -> list[bytes]:
        """The texts of all rules that would fit."""
        labels = host.split(".")
        heads = [h for n in self.lengths if len(h := path.encode()[:n]) == n and h[:1] == b"/"]
        return [".".join(labels[k:]).encode() + h for k in range(len(labels)) for h in heads]


@lru_cache(maxsize=4)
def mapped(name: str) -> RuleArray:
    return RuleArray(SparkFiles.get(name))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def judged_urls(pages: DataFrame, rules: dict[str, str] = RULES, url: str = "url") -> DataFrame:
    """pages with host, path, rule and verdict."""
    local = os.path.join(tempfile.mkdtemp(prefix="curatrix-rules-"), "rules")
    write_rules(rules, local)
    with open(local, "rb") as file:
        name = f"rules-{hashlib.sha256(file.read()).hexdigest()[:32]}"
    os.rename(local, named := os.path.join(os.path.dirname(local), name))
    context = pages.sparkSession.sparkContext
    if not any(f.endswith(name) for f in context.listFiles):
        context.addFile(named)
    made = ("host", "path", "rule", "verdict")
    rows = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c not in made], host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    out = T.StructType([*rows.schema, T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])
    schema = to_arrow_schema(out)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = mapped(name)
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            each = [array.candidates(h, p) if h else [] for h, p in zip(hosts, paths, strict=True)]
            row = np.repeat(np.arange(len(each)), [len(c) for c in each])
            texts = [t for c in each for t in c]
            place = array.find(texts)
            rule, verdict = [None] * len(each), ["allow" if h else "block" for h in hosts]
            for i in np.flatnonzero(place >= 0):
                r, t = int(row[i]), texts[i].decode()
                if rule[r] is None or len(t) > len(rule[r]):
                    rule[r], verdict[r] = t, "block" if array.block[place[i]] else "allow"
            yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(batch.columns, schema, strict=False)), pa.array(rule, pa.string()), pa.array(verdict, pa.string())], schema=schema)

    return rows.mapInArrow(work, out)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged_urls(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


OP6_SQL = r"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
ruled AS (
  SELECT *, CASE WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
                 WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
                 WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                 WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' WHEN host = '' THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""
