"""Numbers packed into binary columns, so that a shuffled posting costs a few bytes."""

from __future__ import annotations

import numpy as np

from reelrec.llm.common import by_value

by_value(__name__)

KEY_BITS = 40                # low bits of a hash that tell it apart inside its fragment
KEY_MASK = (1 << KEY_BITS) - 1


def starts(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, dtype=np.int64)


def fragment_of(h: np.ndarray, fragments: int) -> np.ndarray:
    """Range of the hash, of ``fragments`` equal ones (by the upper 32 bits)."""
    return ((h >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)


def planes(x: np.ndarray, width: int) -> bytes:
    """The ``width`` low bytes of each number, all first bytes first: high ones compress well."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unplanes(data, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(data, dtype=np.uint8).reshape(width, n).T
    return out.reshape(-1).view("<u8").astype(np.uint64)
