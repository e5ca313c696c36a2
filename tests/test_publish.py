"""Published versions: racing writers, crashes between write and swap, readers in between."""

from __future__ import annotations

import threading

import pytest

from curatrix.sources import publish
from curatrix.sources.publish import PublishError, current, guarded_publish, read_version, restored, staged_version, swap, swept
from curatrix.sources.tables import fingerprint


def values(df):
    return sorted(r[0] for r in df.collect())


def test_one_of_two_writers_is_refused(spark, tmp_path):
    root = f"{tmp_path}/t"
    assert current(spark, root) is None
    assert publish.publish(spark.range(3), root, None) == 1
    a, b = staged_version(spark.range(5), root), staged_version(spark.range(7), root)
    assert swap(spark, root, 1, a) == 2
    with pytest.raises(PublishError):
        swap(spark, root, 1, b)
    assert values(read_version(spark, root)) == list(range(5)) and current(spark, root)["rows"] == 5


def test_many_writers_at_once_and_one_wins(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/t"
    publish.publish(spark.range(1), root, None)
    staged = [staged_version(spark.range(10 + k), root) for k in range(6)]
    gate, real, won, lost = threading.Barrier(6), publish._claimed, [], []
    monkeypatch.setattr(publish, "_claimed", lambda *a: (gate.wait(), real(*a))[1])  # all have seen version 1 before any claims 2

    def write(k):
        try:
            won.append((swap(spark, root, 1, staged[k]), k))
        except PublishError:
            lost.append(k)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and len(lost) == 5 and won[0][0] == 2
    assert values(read_version(spark, root)) == list(range(10 + won[0][1]))


def test_a_crash_before_the_swap_changes_nothing(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/t"
    publish.publish(spark.range(4), root, None)
    reader = read_version(spark, root)

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(publish, "_claimed", crash)
        with pytest.raises(RuntimeError):
            publish.publish(spark.range(9), root, 1)
    assert current(spark, root)["number"] == 1 and values(reader) == list(range(4))
    assert publish.publish(spark.range(2), root, 1) == 2
    assert values(reader) == list(range(4)) and values(read_version(spark, root)) == [0, 1]  # the reader's files are still there
    assert swept(spark, root, 2) == 1 and values(read_version(spark, root, 1)) == list(range(4))


def test_only_what_was_reviewed_is_published(spark, tmp_path):
    root = f"{tmp_path}/t"
    publish.publish(spark.range(3), root, None)
    candidate = spark.range(4)
    seen = tuple(fingerprint(candidate).first())
    for wrong in ({"violations": 1}, {"reviewed_version": 7}, {"candidate": spark.range(5)}):
        with pytest.raises(PublishError):
            guarded_publish(wrong.get("candidate", candidate), root, wrong.get("reviewed_version", 1), seen, wrong.get("violations", 0))
    assert current(spark, root)["number"] == 1
    assert guarded_publish(candidate, root, 1, seen) == 2
    with pytest.raises(PublishError):
        guarded_publish(candidate, root, 1, seen)
    assert restored(spark, root, 1) == 3 and values(read_version(spark, root)) == [0, 1, 2]
    with pytest.raises(PublishError):
        restored(spark, root, 9)
    assert swept(spark, root, 1) == 2 and values(read_version(spark, root)) == [0, 1, 2]
