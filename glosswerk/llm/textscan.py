"""Words of many texts at once: places, 64-bit hashes and shingles, in numpy.

Words are runs of bytes that aren't white space (9 to 13 and 32).  A word's
hash is a polynomial of its bytes modulo 2**64, taken as a difference of
prefix sums, then mixed; different words collide with a probability of about
2**-60 a pair.  Bytes are scanned in segments cut at white space, so memory is
bounded by the segment or the longest word.
"""

from __future__ import annotations

from functools import cache

import numpy as np

SEGMENT = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(size, base, _U)
        p[0] = 1
        out.append(np.cumprod(p, dtype=_U))
    return out[0], out[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which each bit depends on all (splitmix64)."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def _segments(space: np.ndarray, offsets: np.ndarray):
    """Byte ranges of about SEGMENT bytes that no word crosses."""
    at, n = 0, len(space)
    while at < n:
        to = min(n, at + SEGMENT)
        if to < n:
            bound = int(offsets[np.searchsorted(offsets, to, side="right") - 1])
            if bound <= at:  # within one text: after its last white space, or else after the next
                back = np.flatnonzero(space[at:to])
                if len(back):
                    bound = at + int(back[-1]) + 1
                else:
                    end = int(offsets[np.searchsorted(offsets, to, side="right")])
                    ahead = np.flatnonzero(space[to:end])
                    bound = to + int(ahead[0]) + 1 if len(ahead) else end
            to = bound
        yield at, to
        at = to


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, their hashes, and each text's first word (one more entry than texts).

    ``data`` is the texts' bytes one after the other, ``offsets`` their bounds.
    """
    space = IS_SPACE[data]
    n = len(data)
    # a word begins after white space or at the start of a text, and ends likewise
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    after = np.empty(n + 1, bool)
    after[0], after[1:] = True, space
    word = ~space
    starts = np.flatnonzero(word & (after[:-1] | edge[:-1]))
    until = np.empty(n, bool)
    if n:
        until[:-1], until[-1] = space[1:], True
    ends = np.flatnonzero(word & (until | edge[1:])) + 1
    hashes = np.empty(len(starts), _U)
    for lo, hi in _segments(space, offsets):
        a, b = np.searchsorted(starts, [lo, hi])
        if a == b:
            continue
        size = SEGMENT if hi - lo <= SEGMENT else 1 << int(hi - lo).bit_length()
        power, inverse = _powers(size + 1)
        sums = np.empty(hi - lo + 1, _U)
        sums[0] = 0
        terms = data[lo:hi].astype(_U)
        terms += _U(1)
        terms *= power[: hi - lo]
        np.cumsum(terms, out=sums[1:])
        s, e = starts[a:b] - lo, ends[a:b] - lo
        hashes[a:b] = mix((sums[e] - sums[s]) * inverse[s])
    return starts, ends, hashes, np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``k`` words of each text, sorted, and their bounds.

    A text of fewer words has its whole sequence as one shingle, one without words none.
    """
    counts = np.diff(first)
    n = len(hashes)
    if n >= k:
        rolled = hashes[: n - k + 1] * _U(0xD6E8FEB86659FD93)
        for j in range(1, k):
            rolled += hashes[j : n - k + 1 + j] * _U((0xD6E8FEB86659FD93 * (2 * j + 1) ** 5 + 2 * j) & (2**64 - 1) | 1)
        rolled = mix(rolled)
    else:
        rolled = np.zeros(0, _U)
    parts, bounds, total = [], np.zeros(len(counts) + 1, np.int64), 0
    for i, m in enumerate(counts.tolist()):
        if m:
            at = first[i]
            if m >= k:
                own = np.sort(rolled[at : at + m - k + 1])
                if len(own) > 1:
                    own = own[np.concatenate([[True], own[1:] != own[:-1]])]
            else:
                h = m
                for w in hashes[at : at + m].tolist():
                    h = (h * 0xA0761D6478BD642F + w + 0xE7037ED1A0B428DB) & (2**64 - 1)
                own = mix(np.array([h], _U))
            parts.append(own)
            total += len(own)
        bounds[i + 1] = total
    return (np.concatenate(parts) if parts else np.zeros(0, _U)), bounds
