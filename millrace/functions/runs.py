"""Runs of consecutive words as 64-bit values, computed batch-wise with numpy."""

from __future__ import annotations

import numpy as np
import xxhash

from millrace.functions.fold import words

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9))
_CACHE_LIMIT = 500_000


class WordHasher:
    """64-bit values of words, remembered up to a bound."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def __call__(self, ws: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > _CACHE_LIMIT:
            known.clear()
        out = np.empty(len(ws), np.uint64)
        for i, w in enumerate(ws):
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
            out[i] = h
        return out


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = (h ^ (h >> np.uint64(31))) * _C
    return h ^ (h >> np.uint64(29))


def run_values(h: np.ndarray, n: int) -> np.ndarray:
    """Values of all runs of n consecutive words, in order; a shorter text has one run of all its words."""
    n = min(n, len(h))
    if n == 0:
        return np.empty(0, np.uint64)
    out = h[: len(h) - n + 1].copy()
    for j in range(1, n):
        out = mix(out * _A + h[j : len(h) - n + 1 + j] * _B)
    return mix(out + np.uint64(n))


def run_set(text: str | None, n: int, hasher: WordHasher) -> np.ndarray:
    """The sorted distinct run values of a text."""
    return np.unique(run_values(hasher(words(text)), n))
