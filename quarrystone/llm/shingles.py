"""Hashes of word shingles and of byte windows, in numpy, for use inside tasks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

_U = np.uint64
_RADIX = 0x9E3779B97F4A7C15
_INVERSE = pow(_RADIX, -1, 2**64)
_TABLE = np.random.Generator(np.random.PCG64(20240229)).integers(0, 2**64, 256, dtype=np.uint64)
#: Words hashed at a time, so that a very long text needs little more memory than its shingles.
_PIECE = 1 << 16


def _powers(base: int, n: int, cache: dict = {}) -> np.ndarray:  # noqa: B006  kept for the worker's life
    got = cache.get(base)
    if got is None or len(got) < n:
        got = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        got[0] = 1
        got = np.cumprod(got, dtype=np.uint64)
        if n <= 1 << 20:
            cache[base] = got
    return got


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _spans(joined: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    n = len(joined)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_TABLE[np.frombuffer(joined, dtype=np.uint8)] * _powers(_RADIX, n)[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _powers(_INVERSE, n + 1)[starts] + (ends - starts).astype(np.uint64))


def _pieces(words: list[bytes], k: int) -> Iterator[np.ndarray]:
    for at in range(0, max(1, len(words) - k + 1), _PIECE):
        part = words[at : at + _PIECE + k - 1]
        ends = np.cumsum(np.fromiter(map(len, part), dtype=np.int64, count=len(part)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        if len(part) < k:
            starts, ends = starts[:1], ends[-1:]
        else:
            starts, ends = starts[: len(part) - k + 1], ends[k - 1 :]
        yield _spans(b" ".join(part), starts, ends)


def shingle_set(text: str | None, k: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles (ASCII lower case, ASCII blanks); all words if fewer than k."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    return np.unique(np.concatenate(list(_pieces(words, k))))


def set_key(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def minhash(hashes: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Minimum over the set of the high half of hash * factor, for each factor."""
    least = np.full(len(factors), 0xFFFFFFFF, dtype=np.uint64)
    for at in range(0, len(hashes), 2048):
        np.minimum(least, (hashes[at : at + 2048, None] * factors).min(axis=0) >> _U(32), out=least)
    return least.astype(np.uint32)
