"""Mentions by dictionary (M1): names of a table found in page texts.

The names' words form a trie. It is kept flat: every prefix of every name (its first word, its
first two, ...) is one 64-bit hash in a sorted array, and a whole name's hash leads to
its rows. A page's words are hashed with the same function, and all positions of a batch of
pages walk down the trie together, one word a step, by binary search; few positions
get past the first step. What ends at a name is compared with its text, so hash
collisions have no effect. The walk is linear in the words read, and nothing is a
Python object but the texts and the candidates.

The dictionary reaches the workers in blocks of ``DICTIONARY_BYTES``; one block is the
common case and is settled within the page's task. With more, each block's candidates are
settled together, page by page, after one shuffle of candidates.

What matches: the name's words one after the other, with the same punctuation between and
around them, runs of white space counting as one space; a name does not start or end
inside a word (a run of ASCII letters, digits and any non-ASCII characters). Of names that overlap, the one that starts first wins, of those the one with more
words, then the longer one; a name with several types is one mention of each.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import schemas as S
from quarry.functions.scratch import materialize
from quarry.functions.wordhash import WORD_CHARS, Words, mixed, text_bytes, words

DICTIONARY_BYTES = 32 << 20  # of names, in a block
PAGES_AT_ONCE = 128
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _walked(first: np.ndarray, following: np.ndarray) -> np.ndarray:
    """The hash of a prefix that is one word longer."""
    return mixed(first * _STEP + following)


@dataclass
class Gazetteer:
    """A block of the dictionary: the trie's prefixes (sorted hashes), for each prefix the range of
    names that end there, and the names in that order."""

    prefixes: np.ndarray
    ends: np.ndarray  # prefixes x 2: its names, from - to
    names: pa.Array
    types: pa.Array
    lead: np.ndarray  # characters of the name before its first word
    trail: np.ndarray  # and after its last

    @classmethod
    def build(cls, names: pa.Array, types: pa.Array) -> Gazetteer:
        """From distinct names (white space collapsed) and their types."""
        found = words(names, WORD_CHARS, fold=False)
        n_words = np.diff(found.texts)
        _, starts = text_bytes(names)
        levels, whole = [], np.zeros(len(names), np.uint64)
        hashes = np.zeros(len(names), np.uint64)
        for depth in range(int(n_words.max(initial=0))):
            here = np.flatnonzero(n_words > depth)
            word = found.hashes[found.texts[here] + depth]
            hashes[here] = mixed(word) if depth == 0 else _walked(hashes[here], word)
            levels.append(hashes[here])
            last = n_words[here] == depth + 1
            whole[here[last]] = hashes[here[last]]
        prefixes = np.unique(np.concatenate(levels)) if levels else np.empty(0, np.uint64)
        worded = np.flatnonzero(n_words > 0)
        order = worded[np.argsort(whole[worded], kind="stable")]
        first, last = found.texts[:-1], found.texts[1:] - 1
        lead = np.zeros(len(names), np.int64)
        trail = np.zeros(len(names), np.int64)
        lead[worded] = found.starts[first[worded]] - starts[:-1][worded]  # ASCII: a byte is a character
        trail[worded] = starts[1:][worded] - found.ends[last[worded]]
        taken, ended = pa.array(order), whole[order]
        ends = np.stack([np.searchsorted(ended, prefixes, "left"), np.searchsorted(ended, prefixes, "right")], axis=1)
        return cls(prefixes, ends, names.take(taken), types.take(taken), lead[order], trail[order])

    def candidates(self, found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, last word and trie prefix wherever the words of a name stand in one text."""
        none = np.empty(0, np.int64)
        out = [(none, none, none)]
        if len(self.prefixes) and len(found.hashes):
            limit = np.repeat(found.texts[1:], np.diff(found.texts))
            at, last = np.arange(len(found.hashes)), np.arange(len(found.hashes))
            here = mixed(found.hashes)
            while len(at):
                place = np.minimum(np.searchsorted(self.prefixes, here), len(self.prefixes) - 1)
                held = self.prefixes[place] == here
                at, last, here, place = at[held], last[held], here[held], place[held]
                named = self.ends[place, 1] > self.ends[place, 0]
                out.append((at[named], last[named], place[named]))
                more = last + 1 < limit[at]
                at, last, here = at[more], last[more] + 1, here[more]
                here = _walked(here, found.hashes[last])
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _collapsed(text: str) -> str:
    return " ".join(text.split())


class _Page:
    """A stripped text with the character offsets of its words."""

    def __init__(self, text: str, found: Words, number: int, begin: int, end: int):
        self.text = text
        a, b = found.texts[number], found.texts[number + 1]
        starts, ends = found.starts[a:b] - begin, found.ends[a:b] - begin
        if not text.isascii():
            chars = np.cumsum((found.data[begin:end] & 0xC0) != 0x80)
            chars = np.r_[0, chars]
            starts, ends = chars[starts], chars[ends]
        self.first, self.starts, self.ends = int(a), starts, ends

    def span(self, first: int, last: int, lead: int, trail: int) -> tuple[int, int]:
        return int(self.starts[first - self.first]) - lead, int(self.ends[last - self.first]) + trail


def _found_in(part: pa.RecordBatch, gazetteer: Gazetteer, text_cap: int | None) -> Iterator[tuple[int, str, list[tuple]]]:
    """Row, stripped text and verified candidates (start, end, n_words, name, type) of the pages with any."""
    texts = [(t or "").strip() for t in part.column("text").to_pylist()]
    seen = texts if text_cap is None else [t[:text_cap] for t in texts]
    column = pa.array(seen, pa.string())
    found = words(column, WORD_CHARS, fold=False)
    first, last, prefix = gazetteer.candidates(found)
    if not len(first):
        return
    _, offsets = text_bytes(column)
    row = np.searchsorted(found.texts, first, "right") - 1
    order = np.argsort(row, kind="stable")
    cuts = np.flatnonzero(np.r_[True, np.diff(row[order]) > 0, True])
    for a, b in pairwise(cuts.tolist()):
        i = int(row[order[a]])
        page = _Page(seen[i], found, i, int(offsets[i]), int(offsets[i + 1]))
        held = []
        for c in order[a:b]:
            for n in range(*gazetteer.ends[prefix[c]]):
                start, end = page.span(int(first[c]), int(last[c]), int(gazetteer.lead[n]), int(gazetteer.trail[n]))
                name = gazetteer.names[n].as_py()
                if start >= 0 and _collapsed(page.text[start:end]) == name and end <= len(page.text):
                    held.append((start, end, int(last[c] - first[c]) + 1, name, gazetteer.types[n].as_py()))
        if held:
            yield i, texts[i], held


def settled(found: list[tuple]) -> list[tuple]:
    """Of candidates (start, end, n_words, name, type) the ones that stay, in text order."""
    out, free, span = [], 0, None
    for start, end, _, name, kind in sorted(set(found), key=lambda f: (f[0], -f[2], -f[1], f[3], f[4])):
        if (start, end) == span or start >= free:
            out.append((start, end, name, kind))
            free, span = end, (start, end)
    return out


def _context(text: str, start: int, end: int) -> str:
    return text[max(0, start - S.MENTION_CONTEXT):end + S.MENTION_CONTEXT].replace("\n", " ").strip()


def _blocks(dictionary: DataFrame, types: Sequence[str], block_bytes: int) -> Iterator[Gazetteer]:
    # white space as str.split sees it, so that names compare with collapsed texts
    name = F.trim(F.regexp_replace(F.col("name"), S.PY_WHITESPACE_CLASS + "+", " "))
    rows = (dictionary.where(F.col("type").isin(list(types))).select(name.alias("name"), "type")
            .where(F.length("name") >= S.MENTION_MIN_LENGTH).distinct())
    rows = materialize(rows, "gazetteer")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("name") + 16), F.lit(0))).first()[0]
    n = max(1, -(-size // block_bytes))
    for block in range(n):
        held = rows if n == 1 else rows.where(F.pmod(F.xxhash64("name"), F.lit(n)) == block)
        table = held.toArrow().combine_chunks()  # at most about DICTIONARY_BYTES
        yield Gazetteer.build(*(table.column(c).combine_chunks().cast(pa.string()) if table.num_rows else pa.array([], pa.string())
                                for c in ("name", "type")))


def extract_mentions_gazetteer(pages: DataFrame, dictionary: DataFrame, types: Sequence[str] = S.ENTITY_TYPES,
                               text_cap: int | None = None, block_bytes: int = DICTIONARY_BYTES) -> DataFrame:
    """(doc_id, page_num, ..., type, name, start, context) per mention of a name of
    ``dictionary(name, type)``; types outside ``types`` are left out before anything is matched.

    Pages are stripped, empty ones have no mentions; names of fewer than two characters or without a word are no names; ``name``
    is the dictionary's; start and context are those of ``extract_mentions``. Null names, null types, repeated
    rows and an empty dictionary are allowed; other columns of ``pages`` are carried along.
    """
    spark = pages.sparkSession
    extra = [f for f in pages.schema.fields if f.name not in ("text", "type", "name", "start", "context")]
    schema = T.StructType([*extra, T.StructField("type", T.StringType()), T.StructField("name", T.StringType()),
                           T.StructField("start", T.IntegerType()), T.StructField("context", T.StringType())])
    kinds = (pa.string(), pa.string(), pa.int32(), pa.string())
    sent = [spark.sparkContext.broadcast(g) for g in _blocks(dictionary, types, block_bytes)]

    def mentions(part: pa.RecordBatch, rows: list[tuple[int, str, list[tuple]]]) -> pa.RecordBatch:
        taken, out = [], []
        for i, text, found in rows:
            for start, end, name, kind in settled(found):
                taken.append(i)
                out.append((kind, name, start, _context(text, start, end)))
        columns = list(zip(*out, strict=True)) or [()] * 4
        at = pa.array(taken, pa.int64())
        return pa.RecordBatch.from_arrays([*(part.column(f.name).take(at) for f in extra),
                                           *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], schema.names)

    def one_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = batch.slice(at, PAGES_AT_ONCE)
                yield mentions(part, list(_found_in(part, sent[0].value, text_cap)))

    pages = pages.select(*[f.name for f in extra], "text")
    if len(sent) == 1:
        return pages.mapInArrow(one_block, schema)

    # several blocks: every block's verified candidates, settled page by page
    held = "start int, end int, n_words int, name string, type string, context string"
    wide = T.StructType([T.StructField("row", T.StructType(extra)), T.StructField("page", T.LongType()),
                         *T._parse_datatype_string(held).fields])
    numbered = materialize(pages.withColumn("page", F.monotonically_increasing_id()), "gazetteer-pages")
    found = None
    for block in sent:
        def in_block(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, PAGES_AT_ONCE):
                    part = batch.slice(at, PAGES_AT_ONCE)
                    taken, out = [], []
                    for i, text, candidates in _found_in(part, block.value, text_cap):
                        for start, end, n_words, name, kind in candidates:
                            taken.append(i)
                            out.append((start, end, n_words, name, kind, _context(text, start, end)))
                    columns = list(zip(*out, strict=True)) or [()] * 6
                    at_row = pa.array(taken, pa.int64())
                    carried = pa.StructArray.from_arrays([part.column(f.name).take(at_row) for f in extra], [f.name for f in extra])
                    yield pa.RecordBatch.from_arrays(
                        [carried, part.column("page").take(at_row),
                         *(pa.array(c, k) for c, k in zip(columns, (pa.int32(),) * 3 + (pa.string(),) * 3, strict=True))], wide.names)

        part = numbered.mapInArrow(in_block, wide)
        found = part if found is None else found.unionByName(part)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _page_runs(batches):
            candidates = list(zip(*(rows.column(c).to_pylist() for c in ("start", "end", "n_words", "name", "type")), strict=True))
            where = {(c[0], c[1], c[3], c[4]): i for i, c in enumerate(candidates)}
            kept = pa.array([where[k] for k in settled(candidates)], pa.int64())
            carried = rows.column("row").take(kept)
            yield pa.RecordBatch.from_arrays([*carried.flatten(), *(rows.column(c).take(kept) for c in ("type", "name", "start", "context"))],
                                             schema.names)

    return found.repartition("page").sortWithinPartitions("page", "start").mapInArrow(settle, schema)


def _page_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of one page after the other (a page's candidates are bounded by its text)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        page = batch.column("page").to_numpy()
        for a, b in pairwise(np.r_[0, np.flatnonzero(page[1:] != page[:-1]) + 1, len(page)].tolist() if len(page) else []):
            if held and held[0].column("page")[0].as_py() != page[a]:
                yield pa.concat_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.concat_batches(held)
