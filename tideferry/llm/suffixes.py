"""Suffix arrays over word numbers, and binary search in them, in numpy.

Words are numbers from 1; 0 ends every match (an unknown word, or a text's
end). Arrays end with enough zeros that reading past a suffix is safe.
"""

from __future__ import annotations

import numpy as np


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes that begin with a known word, sorted by their first ``depth`` words.

    Prefix doubling: equal suffixes form a group, and each round sorts the
    groups by the rank of what follows, twice as far as the round before.
    """
    starts = np.flatnonzero(words)
    order = starts[np.argsort(words[starts], kind="stable")]
    rank = np.zeros(len(words), dtype=np.int64)
    fresh = np.empty(len(order), dtype=bool)
    fresh[:1] = True
    fresh[1:] = words[order[1:]] != words[order[:-1]]
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(1, len(order) + 1), 0))
    open_ = np.arange(len(order))
    reach = 1
    while reach < depth:
        # Groups of one are placed; suffixes that have ended are equal for good and leave below.
        own = rank[order[open_]]
        alone = np.ones(len(open_), dtype=bool)
        same = own[1:] == own[:-1]
        alone[1:] &= ~same
        alone[:-1] &= ~same
        open_ = open_[~alone]
        if not len(open_):
            break
        own = own[~alone]
        after = rank[np.minimum(order[open_] + reach, len(words) - 1)]
        within = np.lexsort((after, own))
        order[open_] = order[open_][within]
        own, after = own[within], after[within]
        fresh = np.ones(len(open_), dtype=bool)
        fresh[1:] = (own[1:] != own[:-1]) | (after[1:] != after[:-1])
        rank[order[open_]] = open_[np.maximum.accumulate(np.where(fresh, np.arange(len(open_)), 0))] + 1
        open_ = open_[after != 0]
        reach *= 2
    return order


def _bound(words: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, offset: int, wanted: np.ndarray) -> np.ndarray:
    """First place in ``order[low:high]`` whose word at ``offset`` is at least ``wanted``, for all searches at once."""
    low, high = low.copy(), high.copy()
    todo = np.flatnonzero(low < high)
    while len(todo):
        middle = (low[todo] + high[todo]) // 2
        less = words[np.minimum(order[middle] + offset, len(words) - 1)] < wanted[todo]
        low[todo[less]] = middle[less] + 1
        high[todo[~less]] = middle[~less]
        todo = todo[low[todo] < high[todo]]
    return low


def search(words: np.ndarray, order: np.ndarray, tests: np.ndarray, starts: np.ndarray, least: np.ndarray):
    """All places where test suffixes match, and how far.

    Each suffix ``tests[start:]`` (ended by a 0) narrows its range of the
    suffix array word by word. Yields ``(which, low, high, length)``: suffixes,
    their ranges, and the length all starts of a range match. Ranges are given
    where they are first ``least`` words long and again whenever they shrink
    or the suffix ends, so the last one given for a start is its longest match.
    """
    which = np.arange(len(starts))
    low = np.zeros(len(starts), dtype=np.int64)
    high = np.full(len(starts), len(order), dtype=np.int64)
    length = 0
    while len(which):
        wanted = tests[starts[which] + length]
        first = _bound(words, order, low, high, length, wanted)
        last = _bound(words, order, first, high, length, wanted + 1)
        last = np.where(wanted == 0, first, last)
        found = last > first
        if length:
            # What a range loses here matches this far and no farther.
            shrunk = (length >= least[which]) & (last - first < high - low)
            if shrunk.any():
                yield which[shrunk], low[shrunk], high[shrunk], length
        which, low, high = which[found], first[found], last[found]
        length += 1
