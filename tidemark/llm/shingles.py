"""Sets of hashed word shingles, and links between sets, inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5
#: Links need 100 * intersection >= 75 * union.
PERCENT = 75

_MULTIPLIER = np.uint64(0x9FB21C651E98DF25)
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class WordHashes(dict):
    """64-bit hashes of words, each computed once; forgotten when there are many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        self[word] = hashed = xxhash.xxh3_64_intdigest(word)
        return hashed


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, hashes: WordHashes) -> np.ndarray:
    """The distinct shingles of a text, sorted; a text of fewer words than a shingle has one of them all."""
    # Both calls see ASCII only, as the definition of words does: A to Z, and the white space \\x20 and \\x09 to \\x0D.
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    n = len(words)
    if n == 0:
        return np.empty(0, dtype=np.uint64)
    ids = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=n)
    length = min(n, WORDS)
    with np.errstate(over="ignore"):
        total = np.full(n - length + 1, length, dtype=np.uint64)
        for k in range(length):
            total = _mixed(total * _MULTIPLIER + ids[k : k + len(total)])
    return np.unique(total)


def set_id(shingles: np.ndarray) -> int:
    """A signed 64-bit id of a set."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes(), seed=len(shingles)))))


def least_overlap(a: int, b: int) -> int:
    """The smallest intersection with which sets of these sizes link."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == 0:
        return 0
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())
