"""Anchors of windows: the first of the least runs, and few of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from rollbook.llm import substring_dedup


def test_few_anchors_are_listed():
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 700)) for _ in range(20)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(20)), pa.array(range(20)), pa.array(texts)], ["_id", "_tie", "text"])
    listed = sum(out.num_rows for out in substring_dedup._anchor_rows(iter([batch])))
    assert 0 < listed < 0.12 * 20 * 700


@pytest.mark.parametrize("n", [0, 1, 14, 15, 34, 35, 36, 90])
def test_each_window_has_the_first_of_its_least_runs(n):
    texts = [" ".join("ab"[k * k % 7 % 2] for k in range(n)), "a " * 80, None, " ".join(f"x{k}" for k in range(n))]
    w = substring_dedup.words(pa.array(texts))
    first, anchor, runs = substring_dedup._anchors(w)
    want = []
    for row, size in enumerate(w.counts.tolist()):
        for at in range(w.first[row], w.first[row] + size - 34):
            hashes = runs[at : at + 21].tolist()
            want.append((at, at + hashes.index(min(hashes))))
    assert list(zip(first.tolist(), anchor.tolist(), strict=True)) == want
