"""Suffix order by two-stage sorting, window hashes and anchors, in numpy, for use inside tasks."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_RADIX = 0x9E3779B97F4A7C15
_TABLE = np.random.Generator(np.random.PCG64(20240301)).integers(0, 2**64, 256, dtype=np.uint64)
#: Symbols are bytes + 1 (0 ends a string), seven of nine bits to a word.
_PER_WORD = 7


def _powers(base: int, n: int, cache: dict = {}) -> np.ndarray:  # noqa: B006  kept for the worker's life
    got = cache.get(base)
    if got is None or len(got) < n:
        got = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        got[0] = 1
        got = np.cumprod(got, dtype=np.uint64)
        if n <= 1 << 22:
            cache[base] = got
    return got[:n]


def window_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every window of ``k`` bytes, by differences of running sums."""
    if len(data) < k:
        return np.empty(0, dtype=np.uint64)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_TABLE[data] * _powers(_RADIX, len(data)), out=sums[1:])
    got = (sums[k:] - sums[:-k]) * _powers(pow(_RADIX, -1, 2**64), len(data) - k + 1)
    got ^= got >> _U(29)
    got *= _U(0xBF58476D1CE4E5B9)
    got ^= got >> _U(32)
    return got


def anchors(texts: list[bytes], span: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every string of ``span`` bytes its anchor, the ``k`` bytes in it of least hash (leftmost of equal ones).

    Returned by runs of strings of one text with one anchor: the text's number, first start, last start, hash of the anchor.
    Equal strings have equal anchors at equal places, whatever surrounds them. Texts are laid end to end; strings that cross
    an end are left out.
    """
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    begins = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    none = np.empty(0, np.int64)
    if len(data) < span:
        return none, none, none, np.empty(0, np.uint64)
    h = window_hashes(data, k)
    # The leading bits of a hash, then its place: the least is the leftmost of least hash.
    bits = _U(max(20, int(len(h)).bit_length()))
    least, length, width = (h >> bits << bits) | np.arange(len(h), dtype=np.uint64), 1, span - k + 1
    while 2 * length <= width:
        least, length = np.minimum(least[: len(least) - length], least[length:]), 2 * length
    if width > length:
        least = np.minimum(least[: len(least) - (width - length)], least[width - length :])
    owner = np.repeat(np.arange(len(texts)), sizes)
    whole = owner[: len(least)] == owner[span - 1 :]
    change = np.concatenate(([True], (least[1:] != least[:-1]) | (owner[1 : len(least)] != owner[: len(least) - 1]) | (whole[1:] != whole[:-1])))
    first = np.flatnonzero(change)
    last = np.concatenate((first[1:], [len(least)])) - 1
    first, last = first[whole[first]], last[whole[first]]
    at = (least[first] & ((_U(1) << bits) - _U(1))).astype(np.int64)
    whose = owner[first]
    return whose, first - begins[whose], last - begins[whose], h[at]


def line_up(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all strings, each ended by 0, and the start of each."""
    sizes = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))
    line = np.zeros(starts[-1], dtype=np.int16)
    keep = np.ones(len(line), dtype=bool)
    keep[starts[1:] - 1] = False
    line[keep] = np.frombuffer(b"".join(strings), dtype=np.uint8).astype(np.int16) + 1
    return line, starts[:-1]


def words(line: np.ndarray) -> np.ndarray:
    """The seven symbols from each place on as one number of the same order; zeros beyond the end."""
    padded = np.concatenate((line, np.zeros(_PER_WORD, dtype=line.dtype))).astype(np.int64)
    out = padded[: len(line)].copy()
    for j in range(1, _PER_WORD):
        out = (out << 9) | padded[j : j + len(line)]
    return out


def suffix_order(line: np.ndarray, word: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes in the order of ``depth`` symbols at least, by two-stage sorting.

    Only suffixes smaller than their successors are sorted directly, word by word and ties alone. All others are induced:
    buckets of one first symbol are scanned in order, and before each suffix found its predecessor, if larger, is the next
    of its own bucket.
    """
    n = len(line)
    step = np.sign(np.diff(line.astype(np.int32), append=-1))
    nearest = np.where(step != 0, np.arange(n), n)
    small = step[np.minimum.accumulate(nearest[::-1])[::-1]] > 0
    order = np.flatnonzero(small)
    padded = np.concatenate((word, np.zeros(depth + _PER_WORD, dtype=word.dtype)))
    key = word[order]
    by = np.argsort(key, kind="stable")
    order, key = order[by], key[by]
    fresh = np.concatenate(([True], key[1:] != key[:-1]))
    for done in range(_PER_WORD, depth, _PER_WORD):
        tied = np.flatnonzero(~(fresh & np.concatenate((fresh[1:], [True]))))
        if not len(tied):
            break
        group, sub = np.cumsum(fresh)[tied], order[tied]
        key = padded[sub + done]
        by = np.lexsort((key, group))
        order[tied], key, group = sub[by], key[by], group[by]
        fresh[tied] = np.concatenate(([True], (key[1:] != key[:-1]) | (group[1:] != group[:-1])))
    kinds = 257
    cuts = np.searchsorted(line[order], np.arange(kinds + 1))
    induced: list[list[np.ndarray]] = [[] for _ in range(kinds)]
    induced[line[n - 1]].append(np.array([n - 1]))
    out = []
    for c in range(kinds):
        bucket = induced[c]
        front = np.concatenate(bucket) if bucket else np.empty(0, np.int64)
        bucket = [front]
        while len(front):  # runs of one symbol
            front = front[front > 0] - 1
            front = front[line[front] == c]
            bucket.append(front)
        found = np.concatenate([*bucket, order[cuts[c] : cuts[c + 1]]])
        out.append(found)
        before = found[found > 0] - 1
        before = before[line[before] > c]
        if len(before):
            first = line[before]
            by = np.argsort(first, kind="stable")
            before, first = before[by], first[by]
            at = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1])))
            for part in np.split(before, at[1:]):
                induced[line[part[0]]].append(part)
    return np.concatenate(out)


def common_prefixes(word: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Symbols that each suffix of ``order`` has in common with the one before it, up to ``most``; 0 for the first."""
    padded = np.concatenate((word, np.zeros(most + _PER_WORD, dtype=word.dtype)))
    out = np.zeros(len(order), dtype=np.int64)
    live = np.arange(1, len(order))
    for at in range(0, most, _PER_WORD):
        differ = padded[order[live] + at] ^ padded[order[live - 1] + at]
        for j in range(_PER_WORD):
            out[live] += (differ >> (9 * (_PER_WORD - 1 - j))) == 0
        live = live[differ == 0]
    return np.minimum(out, most)
