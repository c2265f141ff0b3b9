"""Benchmark decontamination by a distributed positional inverted index.

The corpus is indexed once, by document ranges: a segment holds whole documents
of SEGMENT_WORDS words or a little more, its distinct terms as sorted 64-bit word
hashes, and for each term the positions where it occurs. One row is one segment, so
a search reads the index without a shuffle and can be repeated for another benchmark.

Test items become windows of ``window`` consecutive words, packed into blocks
of bounded size; the blocks are searched one after the other, each sent to all segments.
Within a segment a window's terms are ordered by the length of their lists there. The
rarest list, moved back by the term's offset in the window, gives the starts;
they are intersected with the other lists, likewise moved, rarest first. A window
with an absent term is gone at once.

* phrase matches: all terms at their offsets;
* proximity matches: all terms, in any order, within ``span`` consecutive words. Around
  each position of the rarest term, the starts of a span that hold a term are
  a bit set; a match is a start that all terms' sets have.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased.

Defined edge cases: a null or empty text, or one without words, has no words and is
hit by nothing, an item without words matches nothing; an item shorter than a window is
one window; items that share an item_id are one item; an item without item_id marks
words as hit but is not listed; rows that repeat a doc_id (or lack one) are reported
each for itself; empty tables of documents or items are allowed; further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import cut, slices
from quarry.functions.wordhash import LETTERS_DIGITS, words

WINDOW = 10
SEGMENT_WORDS = 1 << 16
BLOCK_WORDS = 1 << 20  # words of the test items that are sent out at once
STARTS = 1 << 18  # starts that are intersected at once
MAX_SPAN = 64  # a bit set of starts is one word
POS_BITS = 33


def _rows_at_once(words_wanted: int) -> int:
    return min(64, max(1, words_wanted >> 6))


def build_index(docs: DataFrame, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """One row per segment: segment, doc_ids, doc_starts (word offsets, one more than documents),
    terms (sorted hashes), lists (where each term's positions begin), positions."""
    docs = docs.select("doc_id", "text")
    schema = T.StructType([T.StructField("segment", T.LongType()), T.StructField("doc_ids", T.ArrayType(docs.schema["doc_id"].dataType)),
                           T.StructField("doc_starts", T.ArrayType(T.LongType())),
                           *[T.StructField(n, T.BinaryType()) for n in ("terms", "lists", "positions")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << POS_BITS
        ids, held, ends, total = [], [], [0], 0

        def segment() -> pa.RecordBatch:
            hashes = np.concatenate(held) if held else np.empty(0, np.uint64)
            order = np.argsort(hashes, kind="stable")
            ranked = hashes[order]
            first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]]) if len(ranked) else np.empty(0, np.int64)
            binary = [x.tobytes() for x in (ranked[first].astype("<u8"), np.r_[first, len(ranked)].astype("<u4"), order.astype("<u4"))]
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, sum(map(len, ids))], pa.int32()), pa.concat_arrays(ids)),
                 pa.array([ends], pa.list_(pa.int64())), *[pa.array([b], pa.binary()) for b in binary]],
                [f.name for f in schema])

        for part in slices(batches, _rows_at_once(segment_words)):
            found = words(part.column(1), LETTERS_DIGITS)
            ids.append(part.column(0))
            held.append(found.hashes)
            ends += (total + found.texts[1:]).tolist()
            total += len(found.hashes)
            if total >= segment_words:
                yield segment()
                ids, held, ends, total, number = [], [], [0], 0, number + 1
        if ids:
            yield segment()

    return docs.mapInArrow(run, schema)


@dataclass
class Block:
    """Windows of some test items: ``terms`` (windows x window, rows of shorter items end in
    zeros), their ``lengths`` and the number of their item; ``names`` of the items."""

    terms: np.ndarray
    lengths: np.ndarray
    item: np.ndarray
    names: list


def item_blocks(items: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """names, ends, hashes: whole items of ``block_words`` words or a little more in a row."""
    items = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    schema = "names array<string>, ends array<long>, hashes binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held, ends, total = [], [], [], 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([names], pa.list_(pa.string())), pa.array([ends], pa.list_(pa.int64())),
                                               pa.array([np.concatenate(held).astype("<u8").tobytes()], pa.binary())],
                                              ["names", "ends", "hashes"])

        for part in slices(batches, _rows_at_once(block_words)):
            found = words(part.column(1), LETTERS_DIGITS)
            names += part.column(0).to_pylist()
            held.append(found.hashes)
            ends += (total + found.texts[1:]).tolist()
            total += len(found.hashes)
            if total >= block_words:
                yield block()
                names, held, ends, total = [], [], [], 0
        if names:
            yield block()

    # a benchmark of many small files makes few blocks: about two bytes a word at the least
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return items.repartition(-(-size // (2 * block_words)) or 1).mapInArrow(run, schema)


def _windows(names: list, ends: list[int], hashes: bytes, window: int) -> Iterator[Block]:
    """The windows of a block's items, in pieces of bounded size, each window of an item once."""
    found = np.frombuffer(hashes, "<u8")
    held: list[tuple[np.ndarray, int, int]] = []
    total = 0

    def block() -> Block:
        terms = np.zeros((total, window), np.uint64)
        at = 0
        for rows, _, _ in held:
            terms[at:at + len(rows), :rows.shape[1]] = rows
            at += len(rows)
        return Block(terms, np.concatenate([np.full(len(r), n) for r, n, _ in held]),
                     np.concatenate([np.full(len(r), i) for r, _, i in held]), names)

    for i, (a, b) in enumerate(zip([0, *ends], ends, strict=False)):
        n = min(window, b - a)
        if n:
            rows = np.lib.stride_tricks.sliding_window_view(found[a:b], n)
            held.append((rows, n, i))
            total += len(rows)
            if total >= 1 << 16:
                yield block()
                held, total = [], 0
    if held:
        yield block()


class Segment:
    """One segment's index, cut down to the terms of a block."""

    def __init__(self, terms: bytes, lists: bytes, positions: bytes, doc_starts: list[int]):
        self.terms, self.lists = np.frombuffer(terms, "<u8"), np.frombuffer(lists, "<u4").astype(np.int64)
        self.positions, self.doc_starts = np.frombuffer(positions, "<u4"), np.asarray(doc_starts, np.int64)

    def select(self, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every word of the sorted vocabulary the length of its list and where it
        begins among the selected ones; and the selected postings as sorted (term, position) keys."""
        at = np.minimum(np.searchsorted(self.terms, vocabulary), len(self.terms) - 1)
        held = self.terms[at] == vocabulary
        counts = np.where(held, self.lists[at + 1] - self.lists[at], 0)
        begin = np.cumsum(counts) - counts
        where = np.repeat(self.lists[at] - begin, counts) + np.arange(counts.sum())
        keys = np.repeat(np.arange(len(vocabulary)), counts) * self.width + self.positions[where]
        return counts, begin, keys

    @property
    def width(self) -> int:
        return len(self.positions) + MAX_SPAN


def _anchored(block: Block, segment: Segment):
    """The windows whose terms all occur: their terms by list length (shortest first) with offsets,
    and in pieces the pairs of such a window and a position of its rarest term."""
    vocabulary, index = np.unique(block.terms, return_inverse=True)
    index = index.reshape(block.terms.shape)
    counts, begin, keys = segment.select(vocabulary)
    padded = np.arange(block.terms.shape[1]) >= block.lengths[:, None]
    lengths = np.where(padded, np.iinfo(np.int64).max, counts[index])
    live = np.flatnonzero(lengths.min(axis=1) > 0)
    order = np.argsort(lengths[live], axis=1, kind="stable")
    ranked = np.take_along_axis(index[live], order, axis=1)
    rare = ranked[:, 0]
    size = counts[rare]
    ends = np.cumsum(size)
    a = 0
    while a < len(live):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + STARTS, "right")))
        n = size[a:b]
        row = np.repeat(np.arange(a, b), n)
        at = np.repeat(begin[rare[a:b]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        yield live, row, keys[at] - rare[row] * segment.width, ranked, order, keys
        a = b


def phrase_starts(block: Block, segment: Segment) -> tuple[np.ndarray, np.ndarray]:
    """Windows and the positions where they occur inside one document."""
    windows, starts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    if not len(segment.positions):
        return windows[0], starts[0]
    for live, row, position, ranked, order, keys in _anchored(block, segment):
        start = position - order[row, 0]
        size = block.lengths[live[row]]
        doc = np.searchsorted(segment.doc_starts, position, "right") - 1
        fits = (start >= segment.doc_starts[doc]) & (start + size <= segment.doc_starts[doc + 1])
        row, start, size = row[fits], start[fits], size[fits]
        for k in range(1, block.terms.shape[1]):
            if not len(row):
                break
            want = ranked[row, k] * segment.width + start + order[row, k]
            at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            here = (keys[at] == want) | (k >= size)
            row, start, size = row[here], start[here], size[here]
        windows.append(live[row])
        starts.append(start)
    return np.concatenate(windows), np.concatenate(starts)


def near_positions(block: Block, segment: Segment, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows and the positions of their rarest term where all their terms stand within ``span``
    consecutive words of one document."""
    windows, found = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    if not len(segment.positions):
        return windows[0], found[0]
    for live, row, position, ranked, _, keys in _anchored(block, segment):
        doc = np.searchsorted(segment.doc_starts, position, "right") - 1
        low, high = segment.doc_starts[doc], segment.doc_starts[doc + 1]
        size = block.lengths[live[row]]
        starts = np.full(len(row), np.iinfo(np.uint64).max >> np.uint64(64 - span), np.uint64)  # bit j: start at position - j
        for k in range(1, block.terms.shape[1]):
            base = ranked[row, k] * segment.width
            a = np.searchsorted(keys, base + np.maximum(low, position - span + 1))
            b = np.searchsorted(keys, base + np.minimum(high, position + span))
            holds = np.zeros(len(row), np.uint64)
            for step in range(int((b - a).max(initial=0))):
                here = np.flatnonzero(a + step < b)
                shift = position[here] - (keys[a[here] + step] - base[here])  # the term stands shift words before
                # starts position - j <= term <= position - j + span - 1
                from_j, to_j = np.maximum(0, shift), np.minimum(span - 1, span - 1 + shift)
                ones = np.iinfo(np.uint64).max
                holds[here] |= (ones << from_j.astype(np.uint64)) & (ones >> (63 - to_j).astype(np.uint64))
            starts = np.where(k >= size, starts, starts & holds)
        hit = starts != 0
        windows.append(live[row[hit]])
        found.append(position[hit])
    return np.concatenate(windows), np.concatenate(found)


def _search(index: DataFrame, items: DataFrame, window: int, matches) -> DataFrame:
    """segment, doc (its number there), items, starts and lengths of the matches that
    ``matches(block, segment)`` finds; one row per block and document that has any."""
    spark = index.sparkSession
    schema = "segment long, doc int, items array<string>, starts array<long>, lengths array<long>"
    names = ["segment", "doc", "items", "starts", "lengths"]
    out = None
    for row in cut(item_blocks(items), "benchmark-blocks").toLocalIterator():
        sent = spark.sparkContext.broadcast((row.names, row.ends, bytes(row.hashes)))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            blocks = list(_windows(*sent.value, window))
            for batch in batches:
                for number, starts, *index_of in zip(*(batch.column(c).to_pylist() for c in (
                        "segment", "doc_starts", "terms", "lists", "positions")), strict=True):
                    segment = Segment(*index_of, starts)
                    for block in blocks:
                        which, at = matches(block, segment)
                        if len(which):
                            yield _rows(number, segment, block, which, at)

        found = cut(index.select("segment", "doc_starts", "terms", "lists", "positions").mapInArrow(run, schema), "benchmark-matches")
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], schema).select(*names) if out is None else out


def _rows(number: int, segment: Segment, block: Block, which: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    doc = np.searchsorted(segment.doc_starts, at, "right") - 1
    order = np.argsort(doc, kind="stable")
    doc, which, at = doc[order], which[order], at[order]
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    rows: list[list] = [[], [], [], [], []]
    for a, b in zip(first, [*first[1:], len(doc)], strict=True):
        listed = {block.names[i] for i in np.unique(block.item[which[a:b]])}
        spans = np.unique(np.stack([at[a:b] - segment.doc_starts[doc[a]], block.lengths[which[a:b]]]), axis=1)
        for c, v in zip(rows, (number, doc[a], sorted(listed - {None}), spans[0], spans[1]), strict=True):
            c.append(v)
    kinds = (pa.int64(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)],
                                      ["segment", "doc", "items", "starts", "lengths"])


def indexed_documents(index: DataFrame) -> DataFrame:
    """segment, doc, doc_id, n_words of every indexed row."""
    begin, end = F.col("doc_starts")[F.col("doc")], F.col("doc_starts")[F.col("doc") + 1]
    return (index.select("segment", "doc_starts", F.posexplode("doc_ids").alias("doc", "doc_id"))
            .select("segment", "doc", "doc_id", (end - begin).alias("n_words")))


def phrase_matches(index: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """segment, doc, items, starts, lengths: where windows of the items occur, word for word;
    a document has one row per block of items that matches."""
    return _search(index, items, window, phrase_starts)


def proximity_matches(index: DataFrame, items: DataFrame, window: int = WINDOW, span: int = 20) -> DataFrame:
    """Like ``phrase_matches``, for windows whose words stand in any order within ``span``
    words (64 at most); starts are the positions of a window's rarest word."""
    if not 1 <= span <= MAX_SPAN:
        raise ValueError(f"span must be between 1 and {MAX_SPAN}")
    return _search(index, items, window, lambda block, segment: near_positions(block, segment, span))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted item ids), spans (hit words from-to, merged)
    of every document."""
    index = cut(build_index(docs), "benchmark-index")
    found = (phrase_matches(index, items, window).groupBy("segment", "doc")
             .agg(F.flatten(F.collect_list("items")).alias("items"),
                  F.flatten(F.collect_list(F.arrays_zip("starts", "lengths"))).alias("spans")))
    # sweep: spans by start, each extending or opening a run
    merged = F.aggregate(
        F.array_sort(F.transform("spans", lambda s: F.struct(s["starts"].alias("a"), (s["starts"] + s["lengths"]).alias("b")))),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda acc, s: F.struct((acc["n"] + F.greatest(F.lit(0), s["b"] - F.greatest(s["a"], acc["end"]))).alias("n"),
                                F.greatest(acc["end"], s["b"]).alias("end")))
    hits = found.select("segment", "doc", merged["n"].alias("n_hit"), F.array_sort(F.array_distinct("items")).alias("items"), "spans")
    return (indexed_documents(index).join(hits, ["segment", "doc"], "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"), "spans"))


def decontamination_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    return decontaminate(docs, items).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


# DuckDB: every stretch of words as long as a window, joined as text.
REPORT_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
stretches AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM doc_words, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)),
found AS (SELECT s.doc_id, s.i, s.size, v.item_id FROM stretches s JOIN windows v ON v.size = s.size AND v.phrase = s.phrase),
hits AS (SELECT doc_id, count(*) AS n_hit FROM (
  SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS at FROM found) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
           FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(l.n_items, 0) AS n_items,
       coalesce(l.items_sha256, sha256('')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hits h USING (doc_id) LEFT JOIN listed l USING (doc_id)
"""
