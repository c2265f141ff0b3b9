"""Postings of Arrow batches of pages, in numpy.

The tokens are those of the page index: runs of ASCII letters, digits and non-ASCII
bytes, A-Z lower-cased. The occurrences of a batch are ordered by term, then page, then
position, so that every term's are one run: no row is made per occurrence.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa

from quarry.functions.wordhash import LETTERS_DIGITS, LOWERED, text_bytes

SLICE = 1 << 22  # bytes of text whose postings are made at a time


def tokens(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The tokens of all texts in order, and the tokens before each text (one more than texts)."""
    data, offsets = text_bytes(column)
    lowered = LOWERED[data]
    inside = LETTERS_DIGITS[lowered]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    begins[cuts] = inside[cuts]  # a token ends with its text
    starts = np.flatnonzero(begins)
    ends = np.append(np.cumsum(inside)[starts] - 1, np.count_nonzero(inside))
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(lowered[inside]))
    return words, np.searchsorted(starts, offsets)


def _slices(batch: pa.RecordBatch, by: str) -> Iterator[pa.RecordBatch]:
    """Runs of pages of about SLICE bytes in the column ``by``."""
    _, offsets = text_bytes(batch.column(by))
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + SLICE, side="right")) - 1)
        yield batch.slice(low, high - low)
        low = high


def _lists(ends: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def of_pages(key: Sequence[str], columns: Sequence[str], per_page: bool) -> Callable:
    """From batches of the ``key`` columns and a text ``_v_<column>`` for each of ``columns`` (the longest last) the rows
    (term, col, key columns, pos): a row for every term of a slice of pages with a list in each of the last three,
    or, ``per_page``, a row for every term of a page, where only ``pos`` is a list."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, f"_v_{columns[-1]}"):
                for col in columns:
                    words, first = tokens(part.column(f"_v_{col}"))
                    if not len(words):
                        continue
                    coded = words.dictionary_encode()
                    codes = coded.indices.to_numpy()
                    page = np.repeat(np.arange(part.num_rows), np.diff(first))
                    pos = (np.arange(len(codes)) - first[page]).astype(np.int32)
                    if len(coded.dictionary) < 1 << 16:
                        codes = codes.astype(np.uint16)  # sorted in linear time
                    order = np.argsort(codes, kind="stable")  # pages and positions ascend within a term
                    codes, page = codes[order], page[order]
                    change = codes[1:] != codes[:-1]
                    if per_page:
                        change |= page[1:] != page[:-1]
                    starts = np.concatenate(([0], np.flatnonzero(change) + 1))
                    ends = np.append(starts, len(codes))
                    term = coded.dictionary.take(pa.array(codes[starts].astype(np.int32))).cast(pa.string())
                    at = [part.column(k).take(pa.array(page[starts] if per_page else page)) for k in key]
                    keys = at if per_page else [_lists(ends, a) for a in at]
                    yield pa.RecordBatch.from_arrays(
                        [term, pa.array([col] * len(starts), pa.string()), *keys, _lists(ends, pa.array(pos[order]))],
                        ["term", "col", *key, "pos"])
    return make


def count_tokens(column: pa.Array) -> pa.Array:
    """Tokens of every text; null of a null."""
    _, first = tokens(column)
    return pa.array(np.diff(first).astype(np.int32), mask=column.is_null().to_numpy(zero_copy_only=False))
