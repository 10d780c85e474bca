"""Vectorised words and word shingles of Arrow text columns, for use inside Spark tasks.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D; A-Z are lower-cased.  Both are
ASCII rules, so they can be applied to the UTF-8 bytes directly.  A word becomes a 64-bit
polynomial hash of its (lower-cased) bytes, a shingle a 64-bit mix of its word hashes.

Two different shingles share a hash with probability about 2**-64, so a wrong count in one
pair of texts of 10,000 words each has probability about 5e-12.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from reelrec.llm.common import by_value

by_value(__name__)

BLOCK = 1 << 20          # bytes of text handled at once; bounds the memory of one step
WIDTH = 5                # words in a shingle

_BASE = 0x9E3779B97F4A7C15 | 1
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NEWLINE = np.zeros(256, dtype=bool)
NEWLINE[0x0A] = True


def _odd(seed: int, n: int) -> np.ndarray:
    rng = np.random.Generator(np.random.PCG64(seed))
    return rng.integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def byte_table(seed: int, fold: bool = False) -> np.ndarray:
    """A random odd number per byte; with ``fold`` A-Z count as a-z."""
    t = _odd(seed, 256)
    if fold:
        t[65:91] = t[97:123]
    return t


_FOLDED = byte_table(20240607, fold=True)
_COMB = _odd(20240608, 64)                     # one factor per place in a window


class _Powers(dict):
    """Tables of powers by length; they stay behind when the module goes out with a task."""

    def __reduce__(self):
        return (_Powers, ())


_powers = _Powers()


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    size = max(BLOCK, 1 << (n - 1).bit_length())
    if size not in _powers:
        inverse = pow(_BASE, -1, 1 << 64)
        _powers[size] = tuple(
            np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, b, dtype=np.uint64))])
            for b in (_BASE, inverse))
    return _powers[size]


def spans(data: np.ndarray, edges: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are no gap; a run never crosses an edge."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    body = inside[1:-1]
    np.logical_not(gap[data], out=body)
    begin, end = body & ~inside[:-2], body & ~inside[2:]
    cut = edges[(edges > 0) & (edges < len(data))]
    begin[cut] |= body[cut]
    end[cut - 1] |= body[cut - 1]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, by: np.ndarray = _FOLDED) -> np.ndarray:
    """A hash per run of bytes; equal runs get equal ones."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    up, down = _power(len(data))
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(by[data] * up[:len(data)], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts])


def blocks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first, last, bytes, edges)``: the rows first..last-1 of a text column, as many as
    fit in BLOCK bytes but one at least.  Nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, off, body = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, dtype=np.int64)
    data = np.frombuffer(body, dtype=np.uint8) if body is not None and body.size else np.zeros(0, dtype=np.uint8)
    n, first = len(offsets) - 1, 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BLOCK, "right")) - 1)
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def pieces(data: np.ndarray, gap: np.ndarray = SPACE) -> Iterator[np.ndarray]:
    """A long text in blocks that end at a gap (a longer run stays whole)."""
    at = 0
    while at < len(data):
        end = min(at + BLOCK, len(data))
        while end < len(data):
            gaps = np.flatnonzero(gap[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
                break
            end = min(end + BLOCK, len(data))
        yield data[at:end]
        at = end


def block_words(data: np.ndarray, edges: np.ndarray, by: np.ndarray = _FOLDED) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of a block, and its row in the block."""
    if len(edges) == 2 and len(data) > BLOCK:
        none = np.zeros(0, dtype=np.int64)
        h = np.concatenate([word_hashes(p, *spans(p, none), by) for p in pieces(data)])
        return h, np.zeros(len(h), dtype=np.int64)
    s, e = spans(data, edges)
    return word_hashes(data, s, e, by), np.searchsorted(edges, s, "right") - 1


def text_words(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks ``(first, last, words, doc)``: hashes of the words of rows first..last-1, and the
    row of each, counted from ``first``."""
    for first, last, data, edges in blocks(column):
        yield first, last, *block_words(data, edges)


def windows(h: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each place."""
    out = np.zeros(len(at), dtype=np.uint64)
    for k in range(width):
        out += h[at + k] * _COMB[k]
    return mix64(out)


def stretches(h: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Like ``windows``, in time that does not grow with the width."""
    if not len(at):
        return np.zeros(0, dtype=np.uint64)
    up, down = _power(len(h))
    sums = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(mix64(h) * up[:len(h)], out=sums[1:])
    return mix64((sums[at + width] - sums[at]) * down[at])


def shingles(words: np.ndarray, doc: np.ndarray, rows: int, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles ``(doc, hash)`` sorted by both.  A row of fewer than ``width`` words,
    but not none, has its whole sequence as its one shingle."""
    m = max(0, len(words) - width + 1)
    at = np.flatnonzero(doc[:m] == doc[len(doc) - m:])
    parts_h, parts_d = [windows(words, at, width)], [doc[at]]
    counts = np.bincount(doc, minlength=rows)
    ends = np.cumsum(counts)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        h = counts[short].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for k in range(width - 1):
            has = counts[short] > k
            h[has] += words[(ends[short] - counts[short])[has] + k] * _COMB[k]
        parts_h.append(mix64(h + np.uint64(1)))
        parts_d.append(short)
    h, d = np.concatenate(parts_h), np.concatenate(parts_d)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    keep = np.ones(len(h), dtype=bool)
    keep[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return d[keep], h[keep]
