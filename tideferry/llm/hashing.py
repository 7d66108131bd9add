"""64-bit hashes of all words of many texts at once, in numpy.

A word's hash is a polynomial over its bytes, each standing for a random
number, so the hashes of all words come from one running sum over the bytes.
It depends on the word alone and is the same on every machine.
"""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

# Bytes hashed at once; more only where a single word is longer.
CHUNK = 1 << 21

_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_VALUES = np.random.default_rng(BASE).integers(1, 1 << 63, 256, dtype=np.uint64)


class Powers:
    """Powers of the base and of its inverse, as far as they were needed so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            self.up, self.down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(n + n // 4, base, dtype=np.uint64)])) for base in (BASE, INVERSE))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _chunk(data: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    blank = np.ones(len(data) + 2, dtype=bool)
    blank[1:-1] = _BLANK[data]
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    first, end = edges[::2], edges[1::2]
    powers.reach(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_VALUES[data] * powers.up[: len(data)], out=sums[1:])
    return first, mixed((sums[end] - sums[first]) * powers.down[first] + (end - first).astype(np.uint64))


def word_hashes(texts: list[bytes], powers: Powers) -> list[np.ndarray]:
    """For every text, the hashes of its words between ASCII white space."""
    joined = b"\n".join(texts)
    data = np.frombuffer(joined, dtype=np.uint8)
    starts, hashes, begin = [], [], 0
    while begin < len(data):
        end = min(begin + CHUNK, len(data))
        if end < len(data):
            # Cut at a blank, so that no word is split: the last one here, or else the next.
            blanks = np.flatnonzero(_BLANK[data[begin:end]])
            if len(blanks):
                end = begin + int(blanks[-1]) + 1
            else:
                rest = _BLANK[data[end:]]
                end = end + int(rest.argmax()) + 1 if rest.any() else len(data)
        first, found = _chunk(data[begin:end], powers)
        starts.append(first + begin)
        hashes.append(found)
        begin = end
    if not starts:
        return [np.empty(0, dtype=np.uint64) for _ in texts]
    offsets = np.cumsum([0] + [len(text) + 1 for text in texts])
    bounds = np.searchsorted(np.concatenate(starts), offsets)
    hashes = np.concatenate(hashes)
    return [hashes[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
