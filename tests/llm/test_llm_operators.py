"""Every operator against brute force on the awkward table, and its defined results there."""

from __future__ import annotations

import hashlib
import itertools
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
import xxhash
from nasty import SCHEMA, WORD, documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from curatrix.llm import blocks, byte_bpe, imatch, language_id, packing, quality, simhash, substring_dedup, suffix_dedup, toxicity, url_filter
from curatrix.llm.blocks import chunks
from curatrix.llm.encoders import rank_file
from curatrix.sources.session import ship_code


@pytest.fixture(scope="module")
def docs(spark):
    ship_code(spark)
    return spark.createDataFrame(documents(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_by_id():
    """Rows in the order that dedup operators use: null ids first, repeated ones by text."""
    return sorted(((-(1 << 63) if r[0] is None else r[0], r[1] or "") for r in documents()))


def multiset(rows):
    return sorted(map(repr, rows))


def test_substring_dedup(docs, empty):
    least, want = {}, []
    for i, text in rows_by_id():
        w = WORD.findall(text)
        for k in range(len(w) - 12):
            least.setdefault(tuple(w[k : k + 13]), i)
    for i, text in rows_by_id():
        w = WORD.findall(text)
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if least[tuple(w[k : k + 13])] < i:
                gone[k : k + 13] = [True] * 13
        want.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    clash = docs.withColumns({"n_words": F.lit("x"), "extra": F.lit(1)})
    got = substring_dedup.substring_dedup(clash).select(F.coalesce("doc_id", F.lit(-(1 << 63))), "n_words", "n_removed", "kept_text").collect()
    assert multiset(map(tuple, got)) == multiset(want)
    assert substring_dedup.substring_dedup(empty).count() == 0


@pytest.mark.parametrize("most", [20_000, 2])
def test_suffix_dedup(spark, docs, empty, most, monkeypatch):
    seen, want = set(), []
    for i, text in rows_by_id():
        b = text.encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 99):
            if b[k : k + 100] in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(b[k : k + 100])
        want.append((i, len(b), sum(gone), sum(1 for g, _ in itertools.groupby(gone) if g), hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    monkeypatch.setattr(suffix_dedup, "MOST_SEGMENTS", most)  # small: hot minimizers are split
    got = suffix_dedup.suffix_dedup(docs).select(F.coalesce("doc_id", F.lit(-(1 << 63))), "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256)).collect()
    assert multiset(map(tuple, got)) == multiset(want)
    assert suffix_dedup.suffix_dedup(empty).count() == 0


def test_previous_factors_of_a_group():
    text = np.frombuffer(b"abcabcabxabc", np.uint8)
    window = np.arange(len(text) - 2)
    got = suffix_dedup.factors(text, window, np.zeros(len(window), int), 3)
    seen, want = set(), []
    for k in window:
        want.append(bytes(text[k : k + 3]) in seen)
        seen.add(bytes(text[k : k + 3]))
    assert got.tolist() == want


def test_xxh64_matches_the_library():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 3000).astype(np.uint8)
    a = rng.integers(0, 2000, 500)
    b = np.minimum(a + rng.integers(0, 400, 500), len(data))
    assert [int(h) for h in simhash.xxh64_spans(data, a, b)] == [xxhash.xxh64_intdigest(data[x:y].tobytes(), seed=42) for x, y in zip(a, b, strict=True)]


def test_golay_keys_miss_no_link():
    rng = np.random.default_rng(2)
    f = rng.integers(0, 1 << 63, 4000, np.uint64) * np.uint64(2)
    g = f ^ (np.uint64(1) << rng.integers(0, 64, 4000).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 4000).astype(np.uint64))
    golay = simhash.Golay()
    assert len(np.unique(golay.syndrome(golay.leader))) == 2048 and (golay.syndrome(golay.leader) == np.arange(2048)).all()
    (i, x), (j, y) = simhash.keys(f, golay), simhash.keys(g, golay)
    shared = set(zip(i.tolist(), x.tolist(), strict=True)) & set(zip(j.tolist(), y.tolist(), strict=True))
    assert {k for k, _ in shared} == set(range(4000))


def brute_fingerprint(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("small_run", [64, 1])
def test_simhash(spark, docs, empty, small_run, monkeypatch):
    monkeypatch.setattr(simhash, "SMALL_RUN", small_run)  # 1: every bucket is searched by neighbours
    near = spark.createDataFrame([(100 + k, " ".join([*(f"w{j}" for j in range(400)), f"v{k}"]), "en", "s", 1) for k in range(40)], SCHEMA)
    got = simhash.simhash_components(docs.unionByName(near)).toPandas()
    rows = [(r[0], brute_fingerprint(r[1])) for r in [*documents(), *near.collect()]]
    found = np.array(sorted({f for _, f in rows}), np.uint64)
    root = list(range(len(found)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(found)):
        for b in np.flatnonzero(np.bitwise_count(found[a] ^ found) <= 2):
            root[max(top(a), top(int(b)))] = min(top(a), top(int(b)))
    place = {int(f): top(k) for k, f in enumerate(found)}
    least: dict = {}
    for i, f in rows:
        if i is not None:
            least[place[f]] = min(least.get(place[f], i), i)
    want = [(-1 if i is None else i, f, least.get(place[f])) for i, f in rows]
    have = [(-1 if pd.isna(i) else int(i), int(f) & (2**64 - 1), int(c)) for i, f, c in got.itertuples(index=False)]
    assert multiset(have) == multiset(want)
    assert simhash.simhash_components(empty).count() == 0


def test_packing(docs, empty):
    got = packing.packed_digests(docs).toPandas()
    encoder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for i, text, *_ in documents():
        ids = np.array([*encoder.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        want += [(-1 if i is None else i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
    have = [(-1 if pd.isna(r.doc_id) else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got.itertuples()]
    assert multiset(have) == multiset(want)
    ordered = got.sort_values(["sequence_id", "offset"])
    assert (ordered.groupby("sequence_id").length.cumsum() - ordered.length == ordered.offset).all()
    assert got.groupby("sequence_id").length.sum().max() <= 2048
    assert got.sequence_id.nunique() == -(-got.length.sum() // 2048)  # here the bound can be reached
    assert packing.packed_digests(empty).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_piece(seed):
    rng = np.random.default_rng(seed)
    lengths = np.clip((rng.lognormal(6, 1, 3000)).astype(int), 1, 2048) if seed % 2 else rng.integers(1, 2049, 900)
    counts = {int(n): int((lengths == n).sum()) for n in np.unique(lengths)}
    plan = packing.best_plan(counts)
    length = np.concatenate([np.full(c, n) for n, c in counts.items()])
    number = np.concatenate([np.arange(c) for c in counts.values()])
    sequence, offset = plan.place(length, number)
    order = np.lexsort((offset, sequence))
    s, o, n = sequence[order], offset[order], length[order]
    first = np.concatenate([[True], np.diff(s) != 0])
    assert (o[first] == 0).all() and (o[1:][~first[1:]] == (o + n)[:-1][~first[1:]]).all() and (o + n).max() <= 2048
    rooms, used = [], 0  # plain best fit, longest first
    for x in np.sort(lengths)[::-1]:
        k = next((j for j, r in enumerate(rooms) if r >= x), None)
        if k is None:
            used += 1
            rooms.append(2048 - x)
        else:
            rooms[k] -= x
        rooms.sort()
    assert len(np.unique(s)) <= used * 1.01 + 1


def test_language_id(spark, empty):
    rows = [(k, ["the house of the king and the river is cold", "la maison de la reine et les rues sont des", "der Hund und die Katze sind nicht im Haus", "el perro de la casa y los gatos que van"][k % 4] + f" {k}" * 3, language_id.LANGUAGES[k % 4], f"h{k % 4}.example.org", 1) for k in range(200)]
    rows += [(None, None, None, None, None), (900, "", "en", None, 0), (901, "the king and the river of the house", None, None, 1), (901, "the king and the river of the house", None, None, 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = language_id.fused(language_id.of_documents(docs), docs).toPandas()
    assert len(got) == len(rows)
    known = got[got.doc_id < 200]
    assert (known.language == [language_id.LANGUAGES[int(i) % 4] for i in known.doc_id]).all() and known.kept.all()
    assert not got[got.doc_id == 900].kept.any() and (got[got.doc_id == 901].language == "en").all()
    kept = language_id.language_filter(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 2  # the blank one, and the null one
    twin = docs.unionByName(docs.where("doc_id = 5").withColumn("text", F.lit("")))  # a bad row with a good row's id
    assert language_id.language_filter(twin.withColumns({"_id": F.lit(1), "key": F.lit(2)})).where("doc_id = 5").count() == 1
    pages = spark.createDataFrame([(1, "https://www.example.de/fr/x", '<html lang="fr-CA"><script>der die und</script><p>la maison de la reine et les rues</p>'), (2, None, None)], "page_id long, url string, html string")
    both = language_id.fused(language_id.of_documents(docs).unionByName(language_id.of_pages(pages)), docs).where("page_id IS NOT NULL").orderBy("page_id").collect()
    assert (both[0]["language"], both[0]["declared"], both[0]["suffix"], both[0]["host"]) == ("fr", "fr", "fr", "www.example.de") and not both[1]["kept"]
    assert language_id.fused(language_id.of_documents(empty), empty).count() == 0


def test_toxicity(spark, empty):
    rng = np.random.default_rng(5)
    words = [f"word{chr(97 + a)}{chr(97 + b)}" for a in range(20) for b in range(20)]
    texts, toxic = [], []
    for k in range(1200):
        t = rng.choice(words, 60).tolist()
        bad = k % 8 == 0
        if bad:
            for w in rng.choice(["scumbag", "idiotic", "moronic"], 3):
                t.insert(int(rng.integers(60)), str(w))
        texts.append(" ".join(t)), toxic.append(int(bad))
    docs = spark.createDataFrame([*enumerate(texts), (None, None), (5000, ""), (5000, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, y) for k, y in enumerate(toxic) if k % 2 == 0] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity_scores(docs, labels).toPandas()
    assert len(got) == 1203 and got.score.between(0, 1).all()
    held = got[got.held_out & (got.doc_id < 1200)]
    truth = np.array([toxic[int(i)] for i in held.doc_id])
    assert (held.held_out == [zlib.crc32(str(int(i)).encode()) % 4 == 2 for i in held.doc_id]).all()
    assert held.predicted[truth == 1].mean() > 0.9 and held.predicted[truth == 0].mean() < 0.02
    none = toxicity.toxicity_scores(docs.limit(5), labels.where("doc_id < 0"))
    assert none.where("predicted = 1").count() == 0 and toxicity.toxicity_scores(empty.select("doc_id", "text"), labels).count() == 0


def test_toxicity_never_reads_held_out_labels(spark):
    docs = spark.createDataFrame([(k, "plain text " * 30) for k in range(100)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(zlib.crc32(str(k).encode()) % 4 == 2)) for k in range(100)], "doc_id long, toxic int")
    rows, prior = toxicity.sampled(docs, labels)
    assert prior == 0 and rows.where("toxic").count() == 0


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://a.NET", "http://a.NET/", "https://example.net/en/x?q", "https://www.example.com/de/#f", "http://myexample.com/de/", "http://x.org/fr/a", "http://x.org/french", "a://b://c.net/"]
    pages = spark.createDataFrame([(k, u, "h") for k, u in enumerate(urls)] + [(4, "http://a.NET/", "h")], "page_id long, url string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judged_urls(pages).collect()}
    assert got == {
        0: ("", "", None, "block"), 1: ("", "", None, "block"), 2: ("", "", None, "block"), 3: ("a.net", "", None, "allow"), 4: ("a.net", "/", "net/", "block"), 5: ("example.net", "/en/x", "example.net/en/", "allow"),
        6: ("www.example.com", "/de/", "example.com/de/", "block"), 7: ("myexample.com", "/de/", None, "allow"), 8: ("x.org", "/fr/a", "org/fr/", "allow"), 9: ("x.org", "/french", None, "allow"), 10: ("b:", "//c.net/", None, "allow"),
    }
    assert url_filter.judged_urls(pages).count() == 12 and url_filter.judged_urls(pages.limit(0)).count() == 0


def test_rule_array_confirms_stored_texts(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter, "digests", lambda texts: np.array([len(t) % 2 for t in texts], np.uint64))  # all collide
    url_filter.write_rules({"a.com/": "block", "bb.com/": "allow", "ccc.com/x": "block"}, str(tmp_path / "r"))
    array = url_filter.RuleArray(str(tmp_path / "r"))
    places = array.find([b"a.com/", b"bb.com/", b"z.com/", b"ccc.com/x"])
    assert [array.text(p) if p >= 0 else None for p in places] == [b"a.com/", b"bb.com/", None, b"ccc.com/x"]


@pytest.mark.parametrize(("chunk", "overlap"), [(byte_bpe.CHUNK, byte_bpe.OVERLAP), (200, 40)])
def test_byte_bpe(docs, empty, chunk, overlap):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coder: tiktoken.Encoding = rank_file(ranks)
    got = byte_bpe.decode_documents(byte_bpe.encode_documents(docs, ranks, chunk=chunk, overlap=overlap), ranks).collect()
    want = [(-1 if i is None else i, np.array(coder.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t, *_ in documents()]
    assert multiset((-1 if r["id"] is None else r["id"], bytes(r["ids"]), bytes(r["decoded"])) for r in got) == multiset(want)
    assert byte_bpe.encode_documents(empty, ranks).count() == 0


def brute_quality(text):
    w = WORD.findall(text or "")
    grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    hit = {j for k, g in enumerate(grams) if grams.count(g) > 1 for j in (k, k + 1, k + 2)} if len(set(grams)) < len(grams) and len(w) < 4000 else set()
    if len(w) >= 4000:  # counting as above takes too long
        many = {g for g in set(grams) if sum(1 for x in grams if x == g) > 1} if len(set(grams)) < 10 else {g for g, n in pd.Series(grams).value_counts().items() if n > 1}
        hit = {j for k, g in enumerate(grams) if g in many for j in (k, k + 1, k + 2)}
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for x in lines:
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    n = len(w)
    return n, sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(hit), n < 50 or 100 * len(hit) > 50 * n


def test_quality(spark, docs, empty):
    extra = spark.createDataFrame([(200, "a b c\na b c\n\n \na b c d", "en", "s", 1), (201, " ".join(["x y z"] * 40 + [f"q{k}" for k in range(90)]), "en", "s", 1), (202, "| # $ " * 80, "fr", "s", 1)], SCHEMA)
    both = docs.unionByName(extra)
    clash = {c: F.lit("clash") for c in ("kept", "_ref_lang", "_lang", "_words", "_n")}
    judged = quality.quality(both.withColumns(clash))
    assert judged.columns == ["doc_id", "lang", "source", "n_chars", "_ref_lang", "_lang", "_words", "_n", *quality.RESULTS]
    rows = judged.collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    texts = [r[1] for r in documents()] + [r["text"] for r in extra.collect()]
    assert multiset(tuple(r[c] for c in names) for r in rows) == multiset(map(brute_quality, texts))
    assert all(not r["kept"] for r in rows if r["base_failed"])
    kept = quality.quality_filter(both.withColumn("n_words", F.lit("clash")))
    assert kept.columns == [*SCHEMA.replace(" long", "").replace(" string", "").split(", "), "n_words"] and kept.where("doc_id < 12 AND doc_id > 1").count() == 10
    assert quality.quality_filter(empty).count() == 0


def test_imatch(spark, docs, empty):
    """Every row's text and edited text; null ids come first, rows of one id by their texts' hashes, equal rows are one document."""
    rows = {(-(1 << 63) if r[0] is None else r[0], r[1] or "") for r in documents()}
    hashed = {r["t"]: r["h"] for r in spark.createDataFrame([(t,) for _, t in rows], "t string").selectExpr("t", "xxhash64(t) AS h").collect()}
    order = sorted(rows, key=lambda r: (r[0], hashed[r[1]]))
    edited = {}
    for k, (i, text) in enumerate(order):
        half = len(text) // 2
        edited[i, text] = (len(text), hashlib.sha256((text[: len(text) - half] + order[(k + 1) % len(order)][1][:half]).encode()).hexdigest())
    want = [(r[0], *edited[-(1 << 63) if r[0] is None else r[0], r[1] or ""]) for r in documents()]
    got = imatch.imatch_with_edits(docs.withColumns({"_a": F.lit(1), "term": F.lit("x"), "fingerprint": F.lit(0)})).collect()
    assert multiset((r["id"], r["n_chars"], r["edited_sha256"]) for r in got) == multiset(want)
    named = {r["id"]: r["fingerprint"] for r in got}
    assert named[20] == named[21] == named[3] and named[40] == named[41]
    assert imatch.imatch_with_edits(empty).count() == 0


def test_chunks_cover_all_texts():
    at = np.array([0, 0, 5, 5, 50, 51, 60])
    parts = list(chunks(at, 10))
    assert parts[0][0] == 0 and parts[-1][1] == 6 and all(a[1] == b[0] for a, b in zip(parts[:-1], parts[1:], strict=True))


def test_every_block_has_a_partition(spark):
    blocked = blocks.in_blocks(spark.range(4000).withColumn("doc_id", F.col("id")), "doc_id")
    each = blocked.groupBy(F.spark_partition_id(), "_block").count().collect()
    assert len(each) == len({r["_block"] for r in each}) == blocks.BLOCKS_A_PARTITION * blocks.partitions(blocked)


def test_arrays_survive_a_message():
    at = np.array([0, 0, 3, 3, 7])
    numbers = np.array([0, 127, 128, 1 << 20, 5, 1 << 40, 16383])
    column = lambda x: pa.chunked_array([x.slice(0, 1), x.slice(1)])
    got, cuts = blocks.unvarint(column(blocks.varint(numbers, at)))
    assert got.tolist() == numbers.tolist() and cuts.tolist() == at.tolist()
    flags = numbers % 2 == 0
    assert blocks.unbits(column(blocks.bits(flags, at)), at).tolist() == flags.tolist()
    pairs, cuts = blocks.flat(column(blocks.raw(np.arange(14, dtype=np.uint64).reshape(7, 2), at)), "u8", 2)
    assert pairs.tolist() == np.arange(14).reshape(7, 2).tolist() and cuts.tolist() == at.tolist()
    assert blocks.restarted(np.array([1, 2, 3, 4, 5, 6, 7]), at).tolist() == [1, 3, 6, 4, 9, 15, 22]
