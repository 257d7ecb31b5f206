"""Sets of hashed word shingles, computed column-wise over Arrow batches of texts."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Texts are handled in runs of about this many bytes, to bound the memory of a task (a longer text is a run of its own).
RUN_BYTES = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD, _MIX1, _MIX2 = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    h = (h ^ (h >> np.uint64(33))) * _MIX1
    h = (h ^ (h >> np.uint64(33))) * _MIX2
    return h ^ (h >> np.uint64(33))


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """A random value per byte, the same for A-Z and a-z, and which bytes are white space."""
    b = np.arange(256)
    lower = np.where((b >= 65) & (b <= 90), b + 32, b)
    return mix((lower + 1).astype(np.uint64) * _BASE), (b == 32) | ((b >= 9) & (b <= 13))


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    def run(x):
        return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, x, np.uint64)]), dtype=np.uint64)
    return run(_BASE), run(np.uint64(pow(int(_BASE), -1, 1 << 64)))


def _run_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    value, white = _tables()
    docs = len(offsets) - 1
    n = len(data)
    empty = np.empty(0, np.uint64)
    if n == 0:
        return [empty] * docs
    size = 1 << max(19, (n - 1).bit_length())
    power, inverse = _powers(size)
    solid = ~white[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(solid & (edge[:n] | np.concatenate([[True], ~solid[:-1]])))
    end = np.flatnonzero(solid & (edge[1:] | np.concatenate([~solid[1:], [True]]))) + 1
    if not len(start):
        return [empty] * docs
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value[data] * power[:n], dtype=np.uint64)])
    word = mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64) * _WORD)
    doc = np.searchsorted(offsets, start, "right") - 1
    count = np.bincount(doc, minlength=docs)
    first = np.concatenate([[0], np.cumsum(count)])

    def joined(j: int, at: np.ndarray | slice) -> np.ndarray:
        h = np.full(len(word[at]), np.uint64(j))
        for i in range(j):
            h = mix(h * _BASE + (word[at.start + i:at.stop + i] if isinstance(at, slice) else word[at + i]))
        return h

    full = joined(k, slice(0, len(word) - k + 1)) if len(word) >= k else empty
    out = []
    for d in range(docs):
        c, s = count[d], first[d]
        if c == 0:
            out.append(empty)
        elif c < k:
            out.append(joined(int(c), np.array([s])))
        else:
            out.append(np.unique(full[s:s + c - k + 1]))
    return out


def shingle_sets(texts: pa.Array, k: int):
    """Yield, for each text, its sorted distinct ``k``-word shingle hashes.

    A-Z are lower-cased; words are runs without ASCII white space. A text of fewer
    than ``k`` words has one shingle, of them all; one without words (or null) none.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + RUN_BYTES, "right")) - 1)
        j = min(j, len(texts))
        yield from _run_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], k)
        i = j


def signature(s: np.ndarray) -> int:
    """A hash of the set, as a signed 64-bit number."""
    return int(mix(np.array([np.add.reduce(mix(s ^ _WORD), dtype=np.uint64) + np.uint64(len(s))]))[0].astype(np.int64))
