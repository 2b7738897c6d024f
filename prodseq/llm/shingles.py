"""Hashes of word shingles of many texts at once, on flat numpy arrays."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bytes whose powers and running sums are held at once, at eight bytes each.
BLOCK = 1 << 18
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all bits (a bijection)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        made = []
        for base in (_BASE, _INVERSE):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            made.append(np.cumprod(x, dtype=np.uint64))
        _powers = tuple(made)
    return _powers


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of lower-cased (A-Z) texts end to end, and words per text."""
    return hashes_of_runs([t.encode().lower() for t in texts])


def hashes_of_runs(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of bytes other than space and bytes 9 to 13, and runs per entry.

    A run's hash is taken from a running polynomial sum over a block of bytes; the parts of
    a run that lies in several blocks add up to the same hash.
    """
    flat = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    if not len(flat):
        return np.zeros(0, np.uint64), np.zeros(len(raw), np.int64)
    inside = ~((flat == 32) | ((flat >= 9) & (flat <= 13)))
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.zeros(len(starts), np.uint64)
    for low in range(0, len(flat), BLOCK):
        part = flat[low : low + BLOCK]
        first, last = np.searchsorted(ends, low, "right"), np.searchsorted(starts, low + len(part))
        if first == last:
            continue
        power, inverse = _powers_to(len(part))
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[: len(part)], out=total[1:])
        at = np.maximum(starts[first:last], low) - low
        held = (total[np.minimum(ends[first:last] - low, len(part))] - total[at]) * inverse[at]
        if starts[first] < low:
            held[:1] *= np.uint64(pow(int(_BASE), int(low - starts[first]), 1 << 64))
        sums[first:last] += held
    hashes = mixed(sums)
    bounds = np.cumsum([len(r) + 1 for r in raw])
    counts = np.diff(np.searchsorted(starts, bounds), prepend=0)
    return hashes, counts


def shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles of ``width`` words.

    With fewer words the whole sequence is one shingle; without words the set is empty.
    """
    hashes, counts = word_hashes(texts)
    n = len(hashes)
    joined = np.zeros(n, np.uint64)
    for k in range(width):
        joined[: max(0, n - k)] += mixed(hashes[k:] + np.uint64(k + 1))
        joined *= _BASE
    joined = mixed(joined)
    sets, start = [], 0
    for count in counts.tolist():
        if count >= width:
            sets.append(np.unique(joined[start : start + count - width + 1]))
        elif count:
            whole = np.uint64(count)
            for h in hashes[start : start + count]:
                whole = mixed(np.array([whole]) * _BASE + h)[0]
            sets.append(np.array([whole], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
        start += count
    return sets
