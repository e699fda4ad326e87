"""Suffix arrays in numpy: Larsson-Sadakane refinement and Kasai's common prefixes."""

from __future__ import annotations

import numpy as np

PACKED = 7
# A difference of packed symbols is at least this where it reaches the last but k.
DIFFERS = np.array([1 << 9 * k for k in range(1, PACKED)], np.uint64)


def _ranks(keys: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of the first of each run of equal keys in ``order``, and where runs begin."""
    new = np.empty(len(order), bool)
    new[:1] = True
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    first = np.flatnonzero(new)
    return np.repeat(first, np.diff(np.r_[first, len(order)])), new


def suffix_array(keys: np.ndarray, known: int = 1, depth: int | None = None) -> np.ndarray:
    """Suffixes in order of their first ``depth`` symbols (all of them, if None).

    ``keys`` holds, for each suffix, an unsigned number that orders suffixes by their first
    ``known`` symbols. Each round doubles the sorted length with the ranks of the round
    before, and sorts only suffixes whose rank is still shared.
    """
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    at_rank, new = _ranks(keys[order], order)
    rank = np.empty(n, np.int64)
    rank[order] = at_rank
    single = new & np.r_[new[1:], True] if n else new
    open_ = np.flatnonzero(~single)  # places in ``order``
    length = known
    while len(open_) and (depth is None or length < depth):
        suffix = order[open_]
        follow = suffix + length
        second = np.where(follow < n, rank[np.minimum(follow, n - 1)], -1) + 1
        first = rank[suffix]
        # Places of a group follow one another, so sorting within groups keeps their places.
        if n < 1 << 31:
            both = (first << np.int64(32)) | second
            within = np.argsort(both, kind="stable")
            sorted_keys = both[within]
        else:
            within = np.lexsort((second, first))
            sorted_keys = np.stack([first, second], 1)[within].view("i8,i8")[:, 0]
        suffix = suffix[within]
        order[open_] = suffix
        _, new = _ranks(sorted_keys, suffix)
        starts = np.flatnonzero(new)
        sizes = np.diff(np.r_[starts, len(suffix)])
        rank[suffix] = np.repeat(open_[starts], sizes)
        open_ = open_[np.repeat(sizes > 1, sizes)]
        length *= 2
    return order


def packed(symbols: np.ndarray) -> np.ndarray:
    """For each place the next ``PACKED`` symbols (below 512) in one number, 0 past the end."""
    n = len(symbols)
    key = np.zeros(n, np.uint64)
    for k in range(PACKED):
        key <<= np.uint64(9)
        if k < n:
            key[: n - k] |= symbols[k:].astype(np.uint64)
    return key


def common_prefixes(keys: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """For each place in ``order`` the common prefix with the one before it, up to ``limit``.

    Kasai's rule: a suffix shares at most one symbol less with its neighbour than the suffix
    that starts one symbol before it does with its own; so lengths carry over, which needs
    ``order`` to be whole. Lanes of ``limit`` symbols walk through the text side by side.
    ``keys`` are the :func:`packed` symbols, compared as many at a time as they hold.
    """
    n = len(order)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int64)
    lane = np.arange(0, n, limit)
    length = np.zeros(len(lane), np.int64)
    for step in range(min(limit, n)):
        at = lane + step
        if at[-1] >= n:
            inside = at < n
            lane, length, at = lane[inside], length[inside], at[inside]
        other = before[at]
        length = np.where(other >= 0, np.maximum(length - 1, 0), 0)
        going = np.flatnonzero((other >= 0) & (length < limit))
        a, b = at[going] + length[going], other[going] + length[going]
        while len(going):
            inside = (a < n) & (b < n)
            if not inside.all():
                going, a, b = going[inside], a[inside], b[inside]
            differ = keys[a] ^ keys[b]
            same = PACKED - 1 - np.searchsorted(DIFFERS, differ, "right")
            same[differ == 0] = PACKED
            length[going] += same
            more = (differ == 0) & (length[going] < limit)
            going, a, b = going[more], a[more] + PACKED, b[more] + PACKED
        shared[at] = length = np.minimum(length, limit)
    return shared[order]
