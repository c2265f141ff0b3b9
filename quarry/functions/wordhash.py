"""Words of an Arrow text column and their 64-bit hashes, in numpy.

No Python object is made per word: a table says which bytes are word bytes, words
are runs of them inside one text, and a word's hash is a sum over its bytes of a
random number per byte times a power of an odd constant per place. Words of more
than LONG bytes are hashed by BLAKE2b. Two different words share a hash with
chance near 2**-64.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

LONG = 256  # bytes of a word
PIECE = 1 << 18  # bytes hashed at a time
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[ord("A"):ord("Z") + 1] += 32


def byte_table(text: bytes) -> np.ndarray:
    """Which bytes are word bytes: those listed."""
    table = np.zeros(256, bool)
    table[list(text)] = True
    return table


# [^\x20\x09-\x0D]+; [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased texts; the same with upper-case letters
NOT_SPACE = byte_table(bytes(b for b in range(256) if b != 0x20 and not 0x09 <= b <= 0x0D))
LETTERS_DIGITS = byte_table(bytes(b for b in range(256) if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80))
WORD_CHARS = LETTERS_DIGITS | byte_table(bytes(range(0x41, 0x5B)))

_random = np.random.default_rng(29)
_BYTE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.cumprod(np.full(LONG, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)


@dataclass
class Words:
    hashes: np.ndarray  # uint64, in text order
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray
    texts: np.ndarray  # words before each text, one more than there are texts
    data: np.ndarray  # the bytes of all texts, lower-cased if asked for

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins (one more than texts); null is empty."""
    offsets = np.zeros(len(column) + 1, np.int64)
    if not len(column):
        return np.empty(0, np.uint8), offsets
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        kind, column = np.int32, column if pa.types.is_string(column.type) else column.cast(pa.string())
    _, where, data = column.buffers()
    raw = np.frombuffer(where, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    offsets[:] = raw - raw[0]
    if data is None:
        return np.empty(0, np.uint8), offsets
    return np.frombuffer(data, np.uint8)[raw[0]:raw[-1]], offsets


def words(column: pa.Array, table: np.ndarray, fold: bool = True) -> Words:
    """The words of every text of the column, A-Z lower-cased (unless ``fold`` is off)."""
    data, offsets = text_bytes(column)
    if fold:
        data = LOWERED[data]
    inside = table[data]
    edge = np.empty(len(data) + 1, bool)
    edge[0], edge[-1] = True, True
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[offsets] = True
    cuts = np.flatnonzero(edge)
    if len(data) == 0:
        return Words(np.empty(0, np.uint64), *(np.empty(0, np.int64),) * 2, np.zeros(len(offsets), np.int64), data)
    run = inside[cuts[:-1]]
    starts, ends = cuts[:-1][run], cuts[1:][run]
    return Words(hash_spans(data, starts, ends), starts, ends, np.searchsorted(starts, offsets), data)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The 64-bit hashes of stretches of bytes (sorted, apart, none empty)."""
    lengths = ends - starts
    out = np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        # words that begin within PIECE bytes
        b = max(a + 1, int(np.searchsorted(starts, starts[a] + PIECE)))
        size = np.minimum(lengths[a:b], LONG)
        first = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(first, size)
        at = place + np.repeat(starts[a:b], size)
        out[a:b] = np.add.reduceat(_BYTE[data[at]] * _PLACE[place], first)
        a = b
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    for i in np.flatnonzero(lengths > LONG):
        word = data[starts[i]:ends[i]].tobytes()
        out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def hash_words(some: list[bytes]) -> np.ndarray:
    """The hashes of words given by themselves, as they are."""
    return words(pa.array([w.decode() for w in some], pa.string()), byte_table(bytes(range(256))), fold=False).hashes
