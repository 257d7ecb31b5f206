"""Shingle sets are made in small runs: the same sets at any run size, in little memory."""

import tracemalloc

import numpy as np
import pyarrow as pa

from collidex.llm import shingles


def test_short_runs_give_the_same_sets_in_little_memory(monkeypatch):
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 3000, n)) for n in [0, 1, 3, 40, *rng.integers(100, 600, 2000), 200_000]]
    texts = pa.array([*texts, None])
    shingles._powers.cache_clear()
    short = texts.slice(0, 2004)
    tracemalloc.start()
    got = [shingles.signature(s) if len(s) else 0 for s in shingles.shingle_sets(short, 5)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert short.nbytes > 3 << 20 and peak < 40e6          # 2 MB runs took over 75 MB
    got += [shingles.signature(s) if len(s) else 0 for s in shingles.shingle_sets(texts.slice(2004), 5)]
    monkeypatch.setattr(shingles, "RUN_BYTES", 1 << 24)
    assert got == [shingles.signature(s) if len(s) else 0 for s in shingles.shingle_sets(texts, 5)]
