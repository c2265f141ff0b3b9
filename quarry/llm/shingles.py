"""Word shingles of a text as 64-bit hashes, in numpy.

A-Z is lower-cased, words are ``[^\\x20\\x09-\\x0D]+``, a shingle is five
consecutive words; a text with fewer words is one shingle, a text without words
(or null) has none. Words are hashed by ``wordhash``, without a Python object for any; a
shingle's hash is a mixed sum of its words' hashes times odd constants by place.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa

from quarry.functions.wordhash import NOT_SPACE, words


def odd_constants(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Shingler:
    def __init__(self, words: int = 5):
        self.words, self.place = words, odd_constants(words, 5)

    def _shingles(self, ids: np.ndarray) -> np.ndarray:
        if not len(ids):
            return ids
        k = min(self.words, len(ids))
        total = self.place[-k:].sum() + ids[:len(ids) - k + 1] * self.place[0]
        for i in range(1, k):
            total += ids[i:len(ids) - k + 1 + i] * self.place[i]
        return mixed(total)

    def of(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The hash of every shingle of each text of an Arrow column, in text order, repeats included."""
        found = words(column, NOT_SPACE)
        for a, b in pairwise(found.texts.tolist()):
            yield self._shingles(found.hashes[a:b])

    def hashes(self, text: str | None) -> np.ndarray:
        return next(self.of(pa.array([text], pa.string())))

    def distinct(self, text: str | None) -> np.ndarray:
        return np.unique(self.hashes(text))
