"""The trie of conversations against one in plain Python, over one shard and over many."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from curatrix.llm import conversation_trie
from curatrix.llm.conversation_trie import RESULTS, Trie, rebuilt, trie_nodes, turn_lists
from curatrix.sources.session import ship_code

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", digest(role or "", text or ""), text or ""))
    turns = {c: [(r, t) for _, _, r, _, t in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, v in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = int(np.fix(c / 100)) * 100
        whole[c] = turns.get(base, [])[:h] + v[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, v in whole.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
        ends[tuple(v)].append(c)
    children = defaultdict(list)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    under = {}
    for k in sorted(members, key=len, reverse=True):
        own_saved = (len(members[k]) - 1) * len(k[-1][1]) if k else 0
        under[k] = (sum(under[x][0] for x in children[k]) or 1, own_saved + sum(under[x][1] for x in children[k]))
    return sorted(
        repr((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children[k]), under[k][0], under[k][1], sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest())) for k, m in members.items()
    )


def talks():
    rng = random.Random(5)
    rows = []
    for c in range(330):
        shape = rng.randrange(5)
        n = 80 if c % 97 == 1 else rng.randrange(1, 9)
        for t in range(n):
            text = f"hello {t}" if shape < 3 else f"line {rng.randrange(3)} é"
            rows.append((c, t, ["user", "assistant"][t % 2], text))
    rows += [(c, t, "user", f"copy {t}") for c in range(1000, 1150) for t in range(7)]  # copies, a hot group
    rows += [(-150, None, None, None), (-150, 3, "user", "x"), (-150, 3, "user", "x"), (-150, 3, "a", "x"), (7777, 0, "", ""), (None, 0, "user", "lost"), (8888, 0, "user", "é" * 50_000)]
    return rows


@pytest.mark.parametrize("shards", [1, 4, 37])
def test_trie_is_that_of_plain_python(spark, shards):
    ship_code(spark)
    rows = talks()
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    try:
        table = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({"digests": F.lit("x"), "shard": F.lit(1), "turns": F.lit(2)})
        got = trie_nodes(rebuilt(turn_lists(table))).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(repr(tuple(r[c] for c in RESULTS)) for r in got) == brute(rows)


def test_no_conversations(spark):
    ship_code(spark)
    got = trie_nodes(rebuilt(turn_lists(spark.createDataFrame([], SCHEMA))))
    assert got.columns == RESULTS and not got.collect()
    assert not trie_nodes(rebuilt(turn_lists(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)))).collect()


def test_a_family_without_its_base_starts_with_its_own_later_turns(spark):
    ship_code(spark)
    rows = [(c, t, "user", f"{c} {t}") for c in range(205, 225) for t in range(2)]  # some are turnless: they end at the root
    got = trie_nodes(rebuilt(turn_lists(spark.createDataFrame(rows, SCHEMA)))).collect()
    assert sorted(repr(tuple(r[c] for c in RESULTS)) for r in got) == brute(rows)
    assert next(r for r in got if r["depth"] == 0)["ends_sha256"] != conversation_trie.NO_ENDS


def test_ids_of_a_hot_end_are_hashed_in_pieces(spark, monkeypatch):
    ship_code(spark)
    rows = [(c, 0, "user", "same") for c in range(100, 4000)]
    monkeypatch.setattr(conversation_trie, "PIECE", 100)
    got = trie_nodes(turn_lists(spark.createDataFrame(rows, SCHEMA))).where("depth = 1").collect()
    assert [(r["conv_id"], r["n_convs"], r["ends_sha256"]) for r in got] == [(100, 3900, sha256(",".join(map(str, range(100, 4000))).encode()).hexdigest())]


def test_bands_join_where_conversations_are_long():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 255, (3, 16), np.uint8)
    lists = [[0] * 100, [0] * 70, [0] * 70 + [1], [], [2], [0] * 33, [0] * 32]
    at = np.cumsum([0, *map(len, lists)])
    trie = Trie(words[[x for v in lists for x in v]].reshape(-1), np.ones(at[-1], np.int64), at, np.arange(len(lists)))
    assert len(trie.depth) == len({tuple(v[:d]) for v in lists for d in range(len(v) + 1)})
    assert [len(trie.path(int(x))) - 1 for x in trie.last] == [len(v) for v in lists]
