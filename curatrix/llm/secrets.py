"""Secrets in texts: named patterns, and tokens that look like random strings rather than like identifiers.

Everything here is DataFrame functions. Patterns give the base spans. Tokens of MIN_TOKEN characters and more that touch none of
them are judged by two character Markov models, of which one has learned from the values of base spans (labelled random
strings) and one from the tokens in which no digit stands next to a letter (labelled ordinary identifiers; of random keys of 32 letters and
digits, fewer than one in ten thousand look so): grouped counts of character pairs over the whole table, at most 2 * 68 * 68 of them. The random model is half uniform, since a key may use letters that no labelled one had. A token whose
log-likelihood ratio, summed over its pairs, reaches MIN_RATIO is a span of kind random. Ratios are whole thousandths of natural
logarithms, so that sums do not depend on their order.

Positions come from the lengths of what a pattern matches and of what lies between: running sums, made in runs of RUN values, so
that a text with many matches costs their number, not its square. Overlaps are found by running maxima over spans in order.

Defined results: null and empty texts have no spans; positions count code points, ends are exclusive; a base span is a whole match;
spans are in order of start, then kind as in KINDS, then end; a token that touches a base span is never judged, however long; very long
texts are read whole; repeated rows are judged, and learned from, one by one; a table without labelled values has a uniform random
model, an empty one no rows. Columns whose names clash with a result are replaced by it; internal columns clash with none.
"""

from __future__ import annotations

from collections.abc import Callable
from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, once, stored, table

KINDS = ["assign", "access", "hex", "random"]
#: The patterns of base spans, and how long a match (of assign: its value) is at least. Letters of keywords are of either case.
VALUE = "[A-Za-z0-9+/_.=-]+"
ASSIGN = "(?:" + "|".join("".join(f"[{x.upper()}{x}]" if x.isalpha() else x for x in w) for w in ("password", "passwd", "secret", "token", "api_?key")) + r""")["']?\x20*[:=]\x20*["']?"""
ACCESS, HEX = "AKIA[A-Z0-9]{16,}", "[0-9a-f]{24,}"  # runs shorter than 20 and 24 hold no longer match
MIN_VALUE = 6
#: What is judged: runs of these.
MIN_TOKEN = 16
TOKEN = f"[A-Za-z0-9+/_=-]{{{MIN_TOKEN},}}"
#: A token that holds this is no labelled identifier.
MIXED = "[0-9][A-Za-z]|[A-Za-z][0-9]"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
#: A span's ratio is at least that, in thousandths: about a million to one.
MIN_RATIO = 14_000
RUN = 128
RESULTS = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]


def running(values: Column, op: Callable[[Column, Column], Column], zero: Column) -> Column:
    """The results of op over the first 1, 2, 3... of the values; zero begins."""

    def local(run: Column) -> Column:
        return F.aggregate(run, F.array().cast("array<int>"), lambda acc, x: F.array_append(acc, F.when(F.size(acc) == 0, x).otherwise(op(F.element_at(acc, -1), x))))

    def joined(runs: Column) -> Column:
        heads = F.aggregate(runs, F.array(zero), lambda acc, r: F.array_append(acc, op(F.element_at(acc, -1), F.element_at(r, -1))))
        return let(heads, lambda h: F.flatten(F.transform(runs, lambda r, k: F.transform(r, lambda x: op(F.get(h, k), x)))))

    def of(v: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / RUN).cast("int")), lambda k: F.slice(v, k * RUN + 1, RUN))
        return F.when(F.size(v) == 0, v).otherwise(let(F.transform(runs, local), joined))

    return let(values, of)


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of a pattern's matches, leftmost first; positions in code points."""

    def placed(found: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), F.char_length)
        lengths = F.transform(F.arrays_zip(gaps.alias("g"), F.transform(found, F.char_length).alias("n")), lambda x: x["g"] + F.coalesce(x["n"], F.lit(0)))
        ends = running(F.slice(lengths, 1, F.size(found)), lambda a, b: a + b, F.lit(0))
        return F.transform(F.arrays_zip(ends.alias("end"), found.alias("value")), lambda x: F.struct((x["end"] - F.char_length(x["value"])).alias("start"), x["end"].alias("end"), x["value"].alias("value")))

    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(text.rlike(pattern), let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)).otherwise(none)


def untouched(tokens: Column, base: Column) -> Column:
    """The tokens that overlap no base span."""

    def judged(both: Column) -> Column:  # (start, end, value; null in a base span), in order
        ends = running(F.transform(both, lambda x: F.when(x["value"].isNull(), x["end"]).otherwise(0)), F.greatest, F.lit(0))
        never = F.lit(2**31 - 1)
        starts = F.reverse(running(F.transform(F.reverse(both), lambda x: F.when(x["value"].isNull(), x["start"]).otherwise(never)), F.least, never))
        marked = F.arrays_zip(both.alias("x"), ends.alias("before"), starts.alias("after"))
        return F.transform(F.filter(marked, lambda m: m["x"]["value"].isNotNull() & (m["before"] <= m["x"]["start"]) & (m["after"] >= m["x"]["end"])), lambda m: m["x"])

    plain = F.transform(base, lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"), F.lit(None).cast("string").alias("value")))
    return F.when((F.size(tokens) == 0) | (F.size(base) == 0), tokens).otherwise(let(F.array_sort(F.concat(plain, tokens)), judged))


def pairs(value: Column) -> Column:
    """The places in a table of pairs, 128 a first character, of a token's neighbouring characters."""

    def of(codes: Column) -> Column:
        n = F.size(codes) - 1
        return F.transform(F.arrays_zip(F.slice(codes, 1, n).alias("a"), F.slice(codes, 2, n).alias("b")), lambda x: x["a"] * 128 + x["b"])

    codes = F.transform(F.split(value, ""), F.ascii)
    return F.when(F.char_length(value) < 2, F.array().cast("array<int>")).otherwise(let(F.filter(codes, lambda c: c > 0), of))


def ratios(counts: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """128 * 128 log-likelihood ratios in thousandths, from counts of (random, ordinary) by pair."""
    codes = [ord(c) for c in ALPHABET]
    size, table = len(codes), [0] * (128 * 128)
    for a in codes:
        rows = [counts.get((a, b), (0, 0)) for b in codes]
        random, ordinary = (sum(x[k] for x in rows) for k in (0, 1))
        for b, (r, o) in zip(codes, rows, strict=True):
            table[a * 128 + b] = round(1000 * (log(0.5 / size + 0.5 * (r + 1) / (random + size)) - log((o + 1) / (ordinary + size))))
    return table


def as_spans(found: Column, kind: int) -> Column:
    """Matches as spans of a kind."""
    return F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"))).cast("array<struct<start:int,kind:int,end:int>>")


def found_in(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """_row: the columns keep; _base: base spans; _labelled: their values; _tokens: the tokens that touch none."""
    value = lambda x: F.regexp_extract(x["value"], rf"^{ASSIGN}({VALUE})\z", 1)
    t = F.col("_text")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    assign = F.filter(matches(t, ASSIGN + VALUE), lambda x: F.char_length(value(x)) >= MIN_VALUE)
    rows = once(rows, {"_assign": assign, "_access": matches(t, ACCESS), "_hex": matches(t, HEX), "_tokens": matches(t, TOKEN)}).drop("_text")
    kinds = ["_assign", "_access", "_hex"]
    base = F.concat(*[as_spans(F.col(c), k) for k, c in enumerate(kinds)])
    labelled = F.concat(F.transform("_assign", value), *[F.transform(c, lambda x: x["value"]) for c in kinds[1:]])
    return rows.select("_row", F.array_sort(base).alias("_base"), labelled.alias("_labelled"), untouched(F.col("_tokens"), base).alias("_tokens"))


def trained(found: DataFrame) -> list[int]:
    """The ratios by pair, learned from all rows of found_in."""
    samples = [found.select(F.explode(c).alias("v"), F.lit(k).alias("k")) for k, c in enumerate([F.col("_labelled"), F.transform(F.filter("_tokens", lambda x: ~x["value"].rlike(MIXED)), lambda x: x["value"])])]
    pair = samples[0].unionByName(samples[1]).select("k", F.explode(pairs(F.col("v"))).alias("pair"))
    counted = pair.groupBy("pair").agg(F.count_if(F.col("k") == 0).alias("random"), F.count_if(F.col("k") == 1).alias("ordinary"))
    return ratios({divmod(r["pair"], 128): (r["random"], r["ordinary"]) for r in counted.collect()})  # a row for each pair of ALPHABET at most


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    name = lambda k: F.element_at(F.array(*[F.lit(x) for x in KINDS]), k + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def secret_scan(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns keep (none given: all) with RESULTS and secret_spans: array<struct<start, kind, end>>, kind a place in KINDS."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in [*RESULTS, "secret_spans"]]
    found = stored(found_in(docs, text, keep))
    table = F.split(F.lit(",".join(map(str, trained(found)))), ",").cast("array<int>")
    ratio = lambda v: F.aggregate(pairs(v), F.lit(0).cast("long"), lambda acc, p: acc + F.get(table, p))
    random = as_spans(F.filter("_tokens", lambda x: ratio(x["value"]) >= MIN_RATIO), KINDS.index("random"))
    rows = once(found, {"_spans": F.array_sort(F.concat("_base", random))})
    count = lambda k: F.size(F.filter("_base", lambda x: x["kind"] == k)).cast("long")
    return rows.select("_row.*", *[count(k).alias(f"n_{KINDS[k]}") for k in range(3)], F.sha2(listed(F.col("_base")), 256).alias("base_sha256"), listed(F.col("_spans")).alias("spans"), F.col("_spans").alias("secret_spans"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"), keep=["doc_id"]).select("doc_id", *RESULTS)


_quoted = lambda p: "'" + p.replace("'", "''") + "'"
_found = lambda k, p: f"SELECT doc_id, {k} AS kind, regexp_extract_all(text, {_quoted(p)}) AS f, regexp_split_to_array(text, {_quoted(p)}) AS g FROM t"
_SIZE = len(ALPHABET)

OP11_SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
f AS ({" UNION ALL ".join(_found(k, p) for k, p in enumerate((ASSIGN + VALUE, ACCESS, HEX, TOKEN)))}),
m AS (SELECT doc_id, kind, f[i] AS v, (sum(length(g[i]) + CASE WHEN i > 1 THEN length(f[i - 1]) ELSE 0 END) OVER (PARTITION BY doc_id, kind ORDER BY i))::BIGINT AS s FROM (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM f)),
b AS (SELECT doc_id, kind, s, s + length(v) AS e, CASE WHEN kind = 0 THEN regexp_extract(v, {_quoted(f"^{ASSIGN}({VALUE})$")}, 1) ELSE v END AS v FROM m WHERE kind < 3 AND (kind > 0 OR length(regexp_extract(v, {_quoted(f"^{ASSIGN}({VALUE})$")}, 1)) >= {MIN_VALUE})),
tokens AS (SELECT doc_id, 3 AS kind, s, s + length(v) AS e, v FROM m WHERE kind = 3 AND NOT EXISTS (SELECT 1 FROM b WHERE b.doc_id = m.doc_id AND b.s < m.s + length(m.v) AND m.s < b.e)),
pair AS (SELECT kind, doc_id, s, mixed, ascii(v[i]) AS x, ascii(v[i + 1]) AS y FROM (SELECT *, unnest(range(1, length(v))) AS i FROM (SELECT *, false AS mixed FROM b UNION ALL SELECT *, regexp_matches(v, '{MIXED}') FROM tokens))),
n AS (SELECT x, y, count(*) FILTER (kind < 3) AS r, count(*) FILTER (kind = 3 AND NOT mixed) AS o FROM pair GROUP BY 1, 2),
model AS (SELECT x, y, round(1000 * (ln(0.5::DOUBLE / {_SIZE} + 0.5::DOUBLE * (r + 1) / (sum(r) OVER w + {_SIZE})) - ln((o + 1)::DOUBLE / (sum(o) OVER w + {_SIZE})))) AS ratio FROM n WINDOW w AS (PARTITION BY x)),
random AS (SELECT doc_id, s FROM pair JOIN model USING (x, y) WHERE kind = 3 GROUP BY 1, 2 HAVING sum(ratio) >= {MIN_RATIO}),
spans AS (SELECT doc_id, kind, s, e, ['assign', 'access', 'hex', 'random'][kind + 1] || ':' || s || ':' || e AS span FROM (SELECT doc_id, kind, s, e FROM b UNION ALL SELECT doc_id, kind, tokens.s, e FROM tokens JOIN random USING (doc_id, s))),
listed AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex, string_agg(span, ',' ORDER BY s, kind, e) FILTER (kind < 3) AS base, string_agg(span, ',' ORDER BY s, kind, e) AS spans FROM spans GROUP BY 1)
SELECT t.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM t LEFT JOIN listed ON t.doc_id = listed.doc_id
"""
