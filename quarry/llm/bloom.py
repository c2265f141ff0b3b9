"""Two Bloom filters, hashes seen once and hashes seen twice, built as one job.

Every task turns its 64-bit hashes into two bit positions each and emits, for
each segment of the bit space, the positions it hit once and more than once.
One task per segment range merges them (a position is "twice" when one task hit
it twice or two tasks hit it). Only the twice-filter leaves the job: at most
``2**log2_bits / 8`` bytes whatever the corpus size. A larger corpus makes it
less selective, never wrong: what it lets through is confirmed exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SEGMENT_LOG2 = 18


def positions(hashes: np.ndarray, log2_bits: int) -> np.ndarray:
    """The two bit positions of each hash, one row per hash."""
    mask = np.uint64((1 << log2_bits) - 1)
    return np.stack([hashes & mask, (hashes >> np.uint64(32)) & mask], axis=1)


def _segments(pos: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    values, counts = np.unique(pos, return_counts=True)
    segment = (values >> np.uint64(SEGMENT_LOG2)).astype(np.int64)
    local = (values & np.uint64((1 << SEGMENT_LOG2) - 1)).astype(np.uint32)
    starts = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]]) if len(segment) else []
    for a, b in zip(starts, [*starts[1:], len(segment)], strict=True):
        part, twice = local[a:b], counts[a:b] > 1
        yield int(segment[a]), part.tobytes(), part[twice].tobytes()


def twice_filter(df: DataFrame, hashes_of: Callable[[pa.RecordBatch], np.ndarray],
                 log2_bits: int = 27, buffer: int = 1 << 21) -> bytes:
    """The packed twice-seen filter over all hashes that ``hashes_of`` finds in
    the Arrow batches of ``df``. One occurrence in its result is one sighting."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            rows = list(_segments(np.concatenate(held).ravel()))
            names = ["segment", "hit", "twice"]
            for i in range(0, len(rows), 4096):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows[i:i + 4096], strict=True),
                                                    (pa.int64(), pa.binary(), pa.binary()), strict=True)], names)

        for batch in batches:
            held.append(positions(hashes_of(batch), log2_bits))
            size += len(held[-1])
            if size >= buffer:
                yield from flush()
                held, size = [], 0
        if size:
            yield from flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, once, twice = None, None, None

        def done():
            return pa.RecordBatch.from_arrays(
                [pa.array([current], pa.int64()), pa.array([np.packbits(twice, bitorder="little").tobytes()], pa.binary())],
                ["segment", "bits"])

        for batch in batches:
            for seg, hit, more in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if seg != current:
                    if current is not None and twice.any():
                        yield done()
                    current, once, twice = seg, np.zeros(1 << SEGMENT_LOG2, bool), np.zeros(1 << SEGMENT_LOG2, bool)
                hit = np.frombuffer(hit, np.uint32)
                twice[hit[once[hit]]] = True
                twice[np.frombuffer(more, np.uint32)] = True
                once[hit] = True
        if current is not None and twice.any():
            yield done()

    found = (df.mapInArrow(emit, "segment long, hit binary, twice binary")
             .repartition("segment").sortWithinPartitions("segment")
             .mapInArrow(merge, "segment long, bits binary"))
    bits = bytearray(1 << (log2_bits - 3))
    width = 1 << (SEGMENT_LOG2 - 3)
    for row in found.toLocalIterator():
        bits[row.segment * width:(row.segment + 1) * width] = row.bits
    return bytes(bits)


def suspected(hashes: np.ndarray, bits: np.ndarray, log2_bits: int) -> np.ndarray:
    """Which hashes may have been seen twice; no false negatives."""
    pos = positions(hashes, log2_bits)
    hit = (bits[(pos >> np.uint64(3)).astype(np.int64)] >> (pos & np.uint64(7)).astype(np.uint8)) & 1
    return hit.all(axis=1)
