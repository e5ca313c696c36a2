"""Text functions turn few values of a batch into Python objects at a time."""

from __future__ import annotations

import pyarrow as pa

from curatrix.functions import text


def test_long_texts_are_changed_in_slices():
    alive = most = 0

    class Text(str):
        def __new__(cls, value):
            nonlocal alive, most
            alive += 1
            most = max(most, alive)
            return super().__new__(cls, value)

        def __del__(self):
            nonlocal alive
            alive -= 1

    values = pa.array([None if k % 7 == 0 else f"é{k}" for k in range(2000)])
    got = text.changed(values, lambda v: Text(v.upper()))
    assert got.to_pylist() == [None if k % 7 == 0 else f"É{k}" for k in range(2000)]
    assert most <= 2 * 256
    assert text.changed(values.slice(0, 0), str.upper).to_pylist() == [] and text.changed(pa.array([None, "a"]), str.upper, "").to_pylist() == ["", "A"]
