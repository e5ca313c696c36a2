"""What only seems equal is no copy: colliding hashes of windows, minimizers and words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from curatrix.llm import blocks, substring_dedup, suffix_dedup
from curatrix.sources.session import ship_code

SCHEMA = "doc_id long, text string"


def letters(seed: int, n: int) -> str:
    return "".join(chr(97 + c) for c in np.random.default_rng(seed).integers(0, 26, n))


@pytest.mark.parametrize("same", ["upper half", "lower half"])
def test_different_segments_of_one_minimizer_are_no_copies(monkeypatch, same):
    segments, digest = suffix_dedup.Block.segments, suffix_dedup.Block.digest

    def colliding(self, lo, hi):
        start, end, key = segments(self, lo, hi)
        return start, end, np.zeros_like(key)

    half = (lambda d: bytes(8) + d[8:]) if same == "upper half" else (lambda d: d[:8] + bytes(8))
    monkeypatch.setattr(suffix_dedup.Block, "segments", colliding)
    monkeypatch.setattr(suffix_dedup.Block, "digest", staticmethod(lambda x: half(digest(x))))
    texts = [letters(k, 400) for k in range(6)]
    rows = lambda block, some: pa.table({"id": pa.array([k for k, _ in some], pa.int64()), "text": [t for _, t in some], "_block": pa.array([block] * len(some), pa.int32())})
    numbered = list(enumerate(texts))
    blocks_ = [rows(0, numbered[:3]), rows(1, [*numbered[3:], (9, texts[0])])]
    sent = pa.concat_tables([suffix_dedup.introduce(100, 1)(b) for b in blocks_])
    said = suffix_dedup.copies(sent.filter(pa.array(np.array(sent.column("shard")) == 0)))
    copies = [blocks.unbits(said.filter(pa.array(np.array(said.column("block")) == k)).column("a"), suffix_dedup.Block(b, 100, 1).content_cuts) for k, b in enumerate(blocks_)]
    own = suffix_dedup.Block(rows(0, numbered[:1]), 100, 1)
    assert not copies[0].any() and copies[1].sum() == len(own.start)  # those of the repeated text alone


def test_contexts_of_one_gram_stay(spark):
    """Many different strings around one gram: nothing repeats."""
    ship_code(spark)
    gram = letters(99, 40)
    docs = spark.createDataFrame([(k, letters(2 * k, 30) + gram + letters(2 * k + 1, 30)) for k in range(2000)], SCHEMA)
    assert suffix_dedup.suffix_dedup(docs).where("n_removed > 0").count() == 0


def test_words_with_equal_sums_of_powers_stay(spark):
    """The Thue-Morse word and its complement: sums of byte values times powers of an odd base are equal."""
    ship_code(spark)
    morse = "".join("ab"[bin(k).count("1") % 2] for k in range(1024))
    other = morse.translate(str.maketrans("ab", "ba"))
    words = np.frombuffer((morse + other).encode(), np.uint8)
    one, two = blocks.Spans(words)(np.array([0, 1024]), np.array([1024, 2048]))
    assert one == two  # so the sketch takes them for one
    docs = spark.createDataFrame([(1, "x " * 12 + morse), (2, "x " * 12 + other), (3, "x\n" * 12 + other)], SCHEMA)
    assert {r["doc_id"]: r["n_removed"] for r in substring_dedup.substring_dedup(docs).collect()} == {1: 0, 2: 0, 3: 13}


def test_clashing_names_pass_through(spark):
    ship_code(spark)
    text = "a b c d e f g h i j k l m n o p " * 8
    docs = spark.createDataFrame([(1, text, 7, "u", 3, "t", 5), (2, text, 8, "v", 4, "s", 6)], "doc_id long, text string, _id long, _text string, _block long, id string, c0 long")
    for got in (substring_dedup.substring_dedup(docs), suffix_dedup.suffix_dedup(docs)):
        kept = [c for c in docs.columns if c != "text"]
        assert got.columns[:6] == kept and sorted(map(tuple, got.select(*kept).collect())) == sorted(map(tuple, docs.select(*kept).collect()))
