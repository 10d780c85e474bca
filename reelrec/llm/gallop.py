"""Galloping search over sorted lists, all places of a block in lockstep."""

from __future__ import annotations

import numpy as np

from reelrec.llm.common import by_value

by_value(__name__)

STRIDE = 8                   # values that gallop from the rank of the first of them


def _ranks(x: np.ndarray, long: np.ndarray) -> np.ndarray:
    """``ranks`` in a list whose last value is over all others."""
    m = len(x)
    base = np.zeros(m, dtype=np.int64) if m <= STRIDE else np.repeat(_ranks(x[::STRIDE], long), STRIDE)[:m]
    lo, hi = base.copy(), np.full(m, len(long) - 1)
    open_, step = np.arange(m), 0
    while len(open_):                              # steps of 1, 2, 4, ... until a value is large enough
        at = np.minimum(base[open_] + step, len(long) - 1)
        under = long[at] < x[open_]
        hi[open_[~under]] = at[~under]
        open_ = open_[under]
        lo[open_] = at[under] + 1
        step = 2 * step + 1
    open_ = np.flatnonzero(lo < hi)
    while len(open_):                              # then halving inside the last step
        l, h = lo[open_], hi[open_]
        mid = (l + h) >> 1
        under = long[mid] < x[open_]
        l, h = np.where(under, mid + 1, l), np.where(under, h, mid)
        lo[open_], hi[open_] = l, h
        open_ = open_[l < h]
    return lo


def ranks(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each value of the sorted ``short``, how many values of the sorted ``long`` are under it.  Every eighth value is
    placed first, by the same search over fewer values; the others gallop from there."""
    if not len(short) or not len(long):
        return np.zeros(len(short), dtype=np.int64)
    over = max(int(short[-1]), int(long[-1])) + 1
    return _ranks(short, np.append(long, over))


def found(short: np.ndarray, long: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether each value of ``short`` is in ``long``, given its rank there."""
    hit = np.zeros(len(short), dtype=bool)
    inside = at < len(long)
    hit[inside] = long[at[inside]] == short[inside]
    return hit


def common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` of the values that both have (each list without repeats)."""
    if len(a) > len(b):
        ib, ia = common(b, a)
        return ia, ib
    at = ranks(a, b)
    hit = found(a, b, at)
    return np.flatnonzero(hit), at[hit]


def union(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sorted values that either list has: the shorter one's new values are put between runs of the longer."""
    if len(a) > len(b):
        a, b = b, a
    at = ranks(a, b)
    new = ~found(a, b, at)
    return np.insert(b, at[new], a[new])


def merge(lists: list[np.ndarray]) -> np.ndarray:
    """Union of any number of sorted lists, the two shortest first."""
    rest = sorted(lists, key=len)
    while len(rest) > 1:
        rest = sorted([union(rest[0], rest[1]), *rest[2:]], key=len)
    return rest[0] if rest else np.zeros(0, dtype=np.int64)
