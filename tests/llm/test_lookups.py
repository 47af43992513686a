"""Look-ups of the language model: the same answers as plain searches."""

from __future__ import annotations

import numpy as np
import pytest

from demandgrid.llm import elias_fano, ngram_lm


@pytest.mark.parametrize("spread", [3, 1000, 2**40])
def test_find_is_a_search(spread):
    r = np.random.default_rng(spread)
    values = np.unique(np.concatenate((r.integers(0, spread * 900, 700), 10 * spread + np.arange(300)))).astype(np.uint64)
    asked = np.sort(np.concatenate((values, r.integers(0, spread * 1000, 900).astype(np.uint64))))
    at = np.minimum(np.searchsorted(values, asked), len(values) - 1)
    assert elias_fano.EliasFano.of(values).find(asked).tolist() == np.where(values[at] == asked, at, -1).tolist()


def test_find_halves_only_open_runs(monkeypatch):
    """One long run among many short ones: the short ones are not searched again in each of its steps."""
    values = np.concatenate((np.arange(2000) << 30, (2000 << 30) + np.arange(4096))).astype(np.uint64)
    seen, lows = [], elias_fano.EliasFano._lows
    monkeypatch.setattr(elias_fano.EliasFano, "_lows", lambda self, i: seen.append(len(i)) or lows(self, i))
    asked = values[: 2000 + 4]
    assert (elias_fano.EliasFano.of(values).find(asked) == np.arange(len(asked))).all()
    assert sum(seen) < 5 * len(asked) and len(seen) > 5


@pytest.mark.parametrize("words", [0, 5, 40, 10_000])
def test_distinct_numbers(words):
    numbers = np.random.default_rng(words).integers(-1, max(words, 0), 300) if words else np.full(9, -1)
    for got, want in zip(ngram_lm._distinct(numbers, words), np.unique(numbers, return_inverse=True), strict=True):
        assert got.tolist() == want.tolist()
