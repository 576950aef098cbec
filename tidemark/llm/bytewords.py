"""Words of many texts at once, found and hashed by array operations over their bytes."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from tidemark.llm.shingles import _mixed

#: An odd number, of which powers tell the places of bytes in a word apart, and its inverse.
_BASE = 0xB492B66FBE98F273
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes for which powers are kept.
SEGMENT = 1 << 20

with np.errstate(over="ignore"):
    _BYTES = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        return tuple(
            np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base, dtype=np.uint64)]), dtype=np.uint64)
            for base in (_BASE, _INVERSE)
        )


def bytes_among(separators: bytes) -> np.ndarray:
    """For every byte, whether it separates words."""
    return np.isin(np.arange(256), list(separators))


def hashed_words(data: bytes, separating: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of some bytes start and stop, and their 64-bit hashes."""
    text = np.frombuffer(data, dtype=np.uint8)
    inside = np.zeros(len(text) + 2, dtype=bool)
    inside[1:-1] = ~separating[text]
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    starts, stops = turns[::2], turns[1::2]
    power, inverse = _powers(max(2 * SEGMENT, 1 << len(text).bit_length()))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(text) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[text] * power[: len(text)], out=sums[1:])
        hashes = (sums[stops] - sums[starts]) * inverse[starts]
        return starts, stops, _mixed(hashes + (stops - starts).astype(np.uint64))
