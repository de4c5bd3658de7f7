"""Hashes of byte runs, a whole batch of texts at a time with numpy."""

from __future__ import annotations

import numpy as np

_STEP = np.uint64(0x9E3779B97F4A7C15)
_factors = np.ones(0, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def factors(n: int) -> np.ndarray:
    """An odd 64-bit number for each place, from 0 to at least ``n - 1``, that
    has nothing to do with those of other places.  (Powers of one base would
    not do: modulo 2**64 words of two letters in Thue-Morse order collide for
    every base.)"""
    global _factors
    if len(_factors) < n:
        _factors = mix(np.arange(1, max(n, 2 * len(_factors)) + 1, dtype=np.uint64) * _STEP) | np.uint64(1)
    return _factors


def run_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of bytes; equal runs hash alike wherever they
    stand.  Runs are disjoint and in order."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    total = int(lengths.sum())
    shift = np.repeat(starts - np.cumsum(lengths) + lengths, lengths)
    at = np.arange(total) + shift
    rel = at - np.repeat(starts, lengths)
    values = (data[at].astype(np.uint64) + np.uint64(1)) * factors(int(lengths.max()))[rel]
    return mix(np.add.reduceat(values, np.cumsum(lengths) - lengths) + lengths.astype(np.uint64))


def text_bytes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in UTF-8 with a zero byte after each, and where each begins
    (plus the end)."""
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    begins = np.zeros(len(parts) + 1, dtype=np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=begins[1:])
    return np.frombuffer(b"\0".join(parts) + b"\0", dtype=np.uint8), begins


#: A-Z to lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
