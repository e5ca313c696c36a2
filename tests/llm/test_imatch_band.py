"""I-Match fingerprints and likeness against brute force, on short texts and in a large group of copies."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from curatrix.llm import imatch


def brute(texts, spark):
    """near_edited and near_next of each text, from sets of terms."""
    words = [set(t.lower().split()) for t in texts]
    counted = Counter(w for own in {t: set(t.lower().split()) for t in texts}.values() for w in own)
    n = len(set(texts))
    band = sorted(w for w, k in counted.items() if max(2, n / 2000) <= k <= n / 10)
    table = spark.createDataFrame([(w,) for w in band], "w string")
    hashed = {r["w"]: r["h"] for r in table.selectExpr("w", "xxhash64(w) AS h").collect()}
    takes = {w: {h % 128, (h % 128 + (h >> 16) % 127 + 1) % 128} for w, h in hashed.items()}
    parts = lambda own: [frozenset(w for w in own if k in takes.get(w, ())) for k in range(128)]

    def likeness(s, t):
        x, y = parts(set(s.lower().split())), parts(set(t.lower().split()))
        if not any(x) or not any(y):
            return float(s == t)
        either = [k for k in range(128) if x[k] or y[k]]
        return round(sum(x[k] == y[k] for k in either) / len(either), 4)

    out = []
    for k, t in enumerate(texts):
        after, half = texts[(k + 1) % len(texts)], len(t) // 2
        out.append((likeness(t, t[: len(t) - half] + after[:half]), likeness(t, after)))
    return out, set(hashed), words


@pytest.mark.parametrize("size", [6, 60])
def test_likeness_matches_brute_force(spark, size):
    rng = random.Random(size)
    texts = [" ".join(f"w{rng.randrange(15 * size)}" for _ in range(size)) for _ in range(80)]
    texts[11], texts[12] = texts[10] + " also", texts[10]
    want, band, words = brute(texts, spark)
    assert sum(bool(w & band) for w in words) > 70
    got = {r["id"]: r for r in imatch.imatch_with_edits(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")).collect()}
    assert [x for k in range(80) for x in (got[k]["near_edited"], got[k]["near_next"])] == pytest.approx([x for pair in want for x in pair], abs=1.01e-4)  # halves round either way
    assert all(got[k]["fingerprint"].startswith("=") != bool(words[k] & band) for k in range(80))


@pytest.mark.parametrize("most", [imatch.BROADCAST_TERMS, 0])
def test_copies_keep_their_terms(spark, most, monkeypatch):
    monkeypatch.setattr(imatch, "BROADCAST_TERMS", most)  # 0: the lexicon is joined by a shuffle
    base = " ".join(f"c{k}" for k in range(40))
    texts = [base] * 50 + [base + " end"] + [f"u{k} v{k} w{k // 3}" for k in range(49)]
    want, *_ = brute(texts, spark)
    got = {r["id"]: r for r in imatch.imatch_with_edits(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")).collect()}
    assert got[49]["near_next"] == want[49][1] == 1.0 and not got[0]["fingerprint"].startswith("=")
    assert [x for k in range(100) for x in (got[k]["near_edited"], got[k]["near_next"])] == pytest.approx([x for pair in want for x in pair], abs=1.01e-4)
