"""A small table with every awkward case, and its words."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    stems = ["the", "of", "and", "river", "stone", "Été", "naïve", "über", "green", "cold", "house", "walks", "under", "late", "signal"]
    return " ".join(rng.choice(stems) + (rng.choice(["", "s", "ly", "ness", "ing"]) if rng.random() < 0.7 else "") + str(rng.randrange(30)) * (rng.random() < 0.3) for _ in range(n))


def documents() -> list[tuple]:
    passage = prose(99, 60)
    rows = [(k, prose(k, 40 + 13 * k), "en", f"src{k % 3}") for k in range(12)]
    rows += [(20, rows[3][1], "en", "src0"), (21, rows[3][1], "fr", "src0"), (22, rows[3][1] + " end", None, None)]  # copies
    rows += [(k, f"{prose(k, 30)}\n{passage}\n{prose(k + 100, 30)}", "de", "src1") for k in (30, 31, 32)]  # a passage that repeats
    rows += [(40, None, None, None), (41, "", "en", "src0"), (42, " \t\n\x0b ", "en", ""), (43, "one", "es", "a.b.c"), (44, "one two", "xx", "src0")]
    rows += [(50, "ab " * 3000, "en", "src0"), (51, prose(51, 9000), "en", "src0"), (52, "a" * 20_000, "en", "src0"), (53, "é" * 700 + "<|endoftext|>" + "\u2028x", "fr", "src0")]
    rows += [(0, rows[0][1], "en", "src0"), (None, rows[5][1], "en", "src0"), (None, None, None, None)]  # a repeated row, rows without id
    return [(i, t, lang, source, len(t) if t is not None else None) for i, t, lang, source in rows]
