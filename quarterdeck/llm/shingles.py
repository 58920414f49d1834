"""Sets of word shingles of whole texts as arrays of 64-bit hashes, many texts at a time."""

from __future__ import annotations

import numpy as np

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.concatenate([[np.uint64(1)], np.full(255, _BASE, np.uint64)]))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all of them (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    if n <= len(_POWERS):
        return _POWERS
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, _BASE, np.uint64)]))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts (A-Z lower-cased) in order, and where each text's begin, with
    the end of the last."""
    data = [(t or "").encode("utf-8").lower() for t in texts]
    buffer = np.frombuffer(b" " + b" ".join(data) + b" ", np.uint8)
    white = _WHITE[buffer]
    starts = np.flatnonzero(white[:-1] & ~white[1:]) + 1
    ends = np.flatnonzero(~white[:-1] & white[1:]) + 1
    bounds = np.cumsum([1, *[len(d) + 1 for d in data]])
    of_text = np.searchsorted(starts, bounds)
    if not len(starts):
        return np.zeros(0, np.uint64), of_text
    size = ends - starts
    letters = np.flatnonzero(~white)
    first = np.cumsum(size) - size
    place = np.arange(len(letters)) - np.repeat(first, size)
    terms = (buffer[letters].astype(np.uint64) + np.uint64(1)) * _powers(int(size.max()))[place]
    return mix(np.add.reduceat(terms, first) + size.astype(np.uint64)), of_text


def shingle_sets(texts: list[str | None], k: int = 5) -> list[np.ndarray]:
    """The distinct shingles of ``k`` words of every text, sorted; the whole sequence as one where it
    is shorter; none without words."""
    words, of_text = word_hashes(texts)
    factors = mix(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    n = len(words) - k + 1
    run = np.zeros(max(n, 0), np.uint64)
    for j in range(k):
        if n > 0:
            run += words[j : j + n] * factors[j]
    run = mix(run)
    out = []
    for a, b in zip(of_text[:-1].tolist(), of_text[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(run[a : b - k + 1]))
        elif b > a:
            out.append(mix((words[a:b] * factors[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
        else:
            out.append(run[:0])
    return out


def digest(hashes: np.ndarray) -> bytes:
    """128 bits that tell sets of hashes apart."""
    a = mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    b = (mix(hashes + np.uint64(0x1234567)) * np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64)
    return np.array([a, b ^ np.uint64(len(hashes))], np.uint64).tobytes()


def minhashes(sets: list[np.ndarray], many: int, block: int = 1 << 16) -> np.ndarray:
    """``many`` MinHash values (32 bits) of every set, a row each; sets must not be empty."""
    rng = np.random.default_rng(20)
    factors = rng.integers(0, 1 << 63, many, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 1 << 63, many, dtype=np.uint64)
    out = np.empty((len(sets), many), np.uint32)
    i = 0
    while i < len(sets):
        j, size = i, 0
        while j < len(sets) and (j == i or size + len(sets[j]) <= block):
            size += len(sets[j])
            j += 1
        h = np.concatenate(sets[i:j])
        starts = np.cumsum([0, *[len(s) for s in sets[i : j - 1]]])
        for p in range(many):
            out[i:j, p] = np.minimum.reduceat((h ^ shifts[p]) * factors[p], starts) >> np.uint64(32)
        i = j
    return out
