"""The suffix order from keys that carry their positions."""

import numpy as np
import pytest

from tidewatch.llm import runindex


@pytest.mark.parametrize("packed", [63, 30, 8])
def test_sorted_keys_keep_equal_keys_in_order(packed, monkeypatch):
    monkeypatch.setattr(runindex, "PACKED", packed)
    key = np.random.default_rng(packed).integers(0, 50, 3000)
    order, found = runindex.sorted_keys(key, 6)
    assert (order == np.argsort(key, kind="stable")).all() and (found == np.sort(key)).all()


@pytest.mark.parametrize("packed", [63, 30, 8])  # keys of several characters, of one, and too wide for a position
def test_suffix_order(packed, monkeypatch):
    monkeypatch.setattr(runindex, "PACKED", packed)
    rng = np.random.default_rng(5)
    for letters in (1, 2, 200):
        parts = [rng.integers(0, letters, rng.integers(0, 40)) for _ in range(20)]
        text = np.concatenate([np.r_[p, 256 + i] for i, p in enumerate(parts + parts[:3])]).astype(np.int64)
        want = sorted(range(len(text)), key=lambda i: text[i:].tolist())
        assert runindex.suffix_order(text).tolist() == want
    assert runindex.suffix_order(np.array([256])).tolist() == [0]
