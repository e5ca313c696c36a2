"""Ledgers in keyed state: batches, restarts, bases, and keys that are closed after a time without checks."""

from __future__ import annotations

import datetime as dt

from curatrix.streaming import ledger

SCHEMA = "k string, kind int, at timestamp, seq bigint, v string"


def at(minute):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


def arrive(spark, path, n, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{path}/in/p{n}")


def stream(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{path}/in")


def plain(rows):
    out = {}
    for k, kind, t, seq, v in rows:
        count, *now = out.get((k, kind), (0, None, None, None))
        out[k, kind] = (count + 1, *((t, seq, v) if now[0] is None or (t, seq) > (now[0], now[1]) else now))
    return out


def read(spark, path):
    return {(r["k"], r["kind"]): tuple(r[2:]) for r in ledger.latest_ledger(spark, f"{path}/out", ["k", "kind"]).collect()}


def test_ledger_in_batches_with_restart_and_base(spark, tmp_path):
    first = [("a", 1, at(1), 1, "x"), ("a", 1, at(3), 2, "y"), ("b", None, at(2), 3, None), (None, 2, at(9), 4, "n")]
    second = [("a", 1, at(2), 9, "late"), ("b", None, at(2), 5, "tie by number"), ("a", 1, at(3), 2, "y")]
    third = [("c", 1, at(7), 6, "new"), *[("a", 2, at(i), i, str(i)) for i in range(50)]]
    run = lambda: ledger.ledger_stream(spark, stream(spark, tmp_path), f"{tmp_path}/out", f"{tmp_path}/mark", ["k", "kind"], "at", ["v"], "seq").awaitTermination()
    arrive(spark, tmp_path, 0, first)
    run()
    arrive(spark, tmp_path, 1, second)
    run()  # a restart from the checkpoint
    assert read(spark, tmp_path) == plain(first + second)
    assert ledger.compact_ledger(spark, f"{tmp_path}/out", ["k", "kind"]) == 1
    assert read(spark, tmp_path) == plain(first + second)
    arrive(spark, tmp_path, 2, third)
    run()
    assert read(spark, tmp_path) == plain(first + second + third)
    sizes = {r["batch"]: r["count"] for r in spark.read.parquet(f"{tmp_path}/out/changes").groupBy("batch").count().collect()}
    assert sizes == {0: 3, 1: 2, 2: 2}  # what a batch writes are the keys it has
    (tmp_path / "out/base/upto=2").mkdir()  # a base that was not finished counts for nothing
    assert read(spark, tmp_path) == plain(first + second + third)
    assert ledger.compact_ledger(spark, f"{tmp_path}/out", ["k", "kind"]) == 2 and read(spark, tmp_path) == plain(first + second + third)


def test_idle_keys_are_closed_and_start_anew(spark, tmp_path):
    ten = 10 * 60 * 1000
    run = lambda: ledger.idle_ledger_stream(spark, stream(spark, tmp_path), f"{tmp_path}/out", f"{tmp_path}/mark", ["k", "kind"], "at", ["v"], "seq", "0 seconds", ten).awaitTermination()
    arrive(spark, tmp_path, 0, [("a", 1, at(0), 1, "x"), ("a", 1, at(2), 2, "y"), ("b", 1, at(1), 3, "z"), ("b", 1, None, 4, "no stamp")])
    run()
    assert {k: (v[0], v[3], v[4]) for k, v in read(spark, tmp_path).items()} == {("a", 1): (2, "y", False), ("b", 1): (1, "z", False)}
    arrive(spark, tmp_path, 1, [("b", 1, at(9), 5, "still here"), ("c", 1, at(15), 6, "w")])
    run()  # the watermark goes to minute 15: a (until 12) is closed, b (until 19) is not
    got = {k: (v[0], v[3], v[4]) for k, v in read(spark, tmp_path).items()}
    assert got == {("a", 1): (2, "y", True), ("b", 1): (2, "still here", False), ("c", 1): (1, "w", False)}
    arrive(spark, tmp_path, 2, [("a", 1, at(16), 7, "anew"), ("c", 1, at(3), 8, "too late")])
    run()
    got = {k: (v[0], v[3], v[4]) for k, v in read(spark, tmp_path).items()}
    assert got == {("a", 1): (1, "anew", False), ("b", 1): (2, "still here", False), ("c", 1): (1, "w", False)}
