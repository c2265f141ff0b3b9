"""Hierarchical packing of documents into windows of several context sizes.

A document is its token ids and an end id. Each ids lies in one piece:

1. whole windows of the longest tier are cut from the front of long documents;
2. the rest of a document goes to the shortest tier that holds it;
3. windows are opened by the longest rests first; the gap of a window is filled
   from shorter rests, the longest that fits first, the last one cut to close
   the gap;
4. what cannot fill a window any more is cut at powers of two, so that every
   window is exactly a tier long and nothing is padded;
5. windows are dealt to step groups, the fullest to the emptiest, so that the
   groups hold equal numbers of tokens.

The work is one narrow pass: each task tokenizes its texts and packs them in
chunks of ``chunk_tokens`` tokens, which bounds memory and makes every chunk
recomputable from its input split alone. Sequence ids count from the partition
number. Texts are cut into the pieces that the vocabulary's pre-tokenizer makes, and the ids
of a piece are remembered (``TextIds``).

Defined edge cases: null or empty text is the end id alone; very long texts
span many windows; rows that repeat a doc_id (or lack one) are packed
each for itself; an empty table gives no pieces; further columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quarry.functions.wordhash import LONG, LOWERED, hash_spans, text_bytes
from quarry.llm.common import per_process, slices

WINDOW = 2048
END_ID = 1
CHUNK_TOKENS = 1 << 21
STEP_TOKENS = 64 * WINDOW
MEMO_PIECES = 1_000_000  # remembered pieces, about 40 bytes each
RECENT = 1 << 16  # pieces that wait to be sorted in among the others
DOCS_AT_ONCE, BYTES_AT_ONCE = 512, 1 << 22

SPACE, LETTER, DIGIT, OTHER = range(4)
_CLASS = np.full(256, OTHER, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = SPACE
_CLASS[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = LETTER  # of lower-cased texts; above ASCII Latin letters alone (_simple)
_CLASS[0x30:0x3A] = DIGIT
_PROBE = "abcxyz ABC Z ab. a,b c### d-"


class PieceIds:
    """Token ids of pieces, in arrays: sorted hashes, where a piece's ids begin and how many they are,
    and a check (first bytes and length) beside the hash. New pieces gather in a small table before they are
    sorted in. When MEMO_PIECES are remembered, those not met since the last time are forgotten."""

    def __init__(self):
        self.tables = [self._empty(), self._empty()]  # many, recent
        self.ids, self.used = np.empty(0, np.uint32), 0

    @staticmethod
    def _empty() -> dict[str, np.ndarray]:
        return {"hash": np.empty(0, np.uint64), "check": np.empty(0, np.uint64), "first": np.empty(0, np.int64),
                "count": np.empty(0, np.int32), "met": np.empty(0, bool)}

    def find(self, hashes: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of pieces begin (-1: not known) and how many they are."""
        first, count = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        for table in self.tables:
            if len(table["hash"]):
                at = np.minimum(np.searchsorted(table["hash"], hashes), len(table["hash"]) - 1)
                held = (table["hash"][at] == hashes) & (table["check"][at] == checks)
                first[held], count[held] = table["first"][at[held]], table["count"][at[held]]
                table["met"][at[held]] = True
        return first, count

    def add(self, hashes: np.ndarray, checks: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        if self.used + len(ids) > len(self.ids):
            grown = np.empty(max(2 * len(self.ids), self.used + len(ids), 1 << 16), np.uint32)
            grown[:self.used] = self.ids[:self.used]
            self.ids = grown
        self.ids[self.used:self.used + len(ids)] = ids
        new = {"hash": hashes, "check": checks, "first": self.used + np.cumsum(counts) - counts, "count": counts.astype(np.int32),
               "met": np.ones(len(hashes), bool)}
        self.used += len(ids)
        self.tables[1] = self._merged(self.tables[1], new)
        if len(self.tables[1]["hash"]) > RECENT:
            self.tables = [self._merged(*self.tables), self._empty()]
            if len(self.tables[0]["hash"]) > MEMO_PIECES:
                self._forget()

    @staticmethod
    def _merged(a: dict, b: dict) -> dict:
        order = np.argsort(np.concatenate([a["hash"], b["hash"]]), kind="stable")
        return {n: np.concatenate([a[n], b[n]])[order] for n in a}

    def _forget(self) -> None:
        table = self.tables[0]
        kept = table["met"]
        if kept.sum() > MEMO_PIECES * 3 // 4:  # all are in use: start anew
            self.__init__()
            return
        table = {n: c[kept] for n, c in table.items()}
        self.ids = self.ids[_ranges(table["first"], table["count"])]
        self.used = len(self.ids)
        table["first"] = np.cumsum(table["count"], dtype=np.int64) - table["count"]
        table["met"][:] = False
        self.tables[0] = table


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for count[0] places, then those of first[1], ..."""
    count = count.astype(np.int64)
    return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


class TextIds:
    """Token ids of whole texts, as little-endian unsigned 32-bit numbers.

    A text is cut into pieces as the tokenizer's own rule does: runs of letters, single digits, runs of other
    characters; a word with an apostrophe stays whole, as the rule looks further there. Pieces are hashed
    and looked up for a slice of texts at once, without an object for any; new ones are encoded by the
    tokenizer. Texts with characters whose class or normal form is not plain from their bytes
    (all but ASCII and Latin letters), or with a special token's spelling, and all texts of tokenizers
    that do not cut like this, are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.pieces = PieceIds()
        self.mapped = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.marks = sorted({t.content[:2].lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()})
        self.cuts = self._cuts_alike()

    def _cuts_alike(self) -> bool:
        """Whether this tokenizer lower-cases, cuts as described, and spells bytes as ByteLevel does."""
        normal, split = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        if normal is None or split is None or normal.normalize_str(_PROBE + " Éö") != (_PROBE + " Éö").lower():
            return False
        pieces = [p for p, _ in split.pre_tokenize_str("ab. cé,###12 d-e_f3")]
        return pieces == ["ab", ".", "c" + self.mapped("é")[0][0], ",###", "1", "2", "d", "-", "e", "_", "f", "3"]

    def whole(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _simple(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which texts can be cut into pieces."""
        bad = np.flatnonzero(data >= 0x80)
        lead = data[bad] >= 0xC0
        after = data[np.minimum(bad + 1, len(data) - 1)] if len(bad) else data[:0]
        # two-byte letters U+00C0 to U+024F but the signs U+00D7 and U+00F7
        wrong = lead & ((data[bad] < 0xC3) | (data[bad] > 0xC8) | ((data[bad] == 0xC3) & ((after == 0x97) | (after == 0xB7))))
        places = [bad[wrong]]
        for mark in self.marks:
            here = data[:-1] == mark[0]
            if len(mark) > 1:
                here &= data[1:] == mark[1]
            places.append(np.flatnonzero(here))
        out = np.ones(len(offsets) - 1, bool)
        out[np.searchsorted(offsets, np.concatenate(places), "right") - 1] = False
        return out

    def batch(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of every text of an Arrow column; null is empty."""
        if not self.cuts:
            return [self.whole(t or "") for t in column.to_pylist()]
        data, offsets = text_bytes(column)
        data = LOWERED[data]
        if not len(data):
            return [np.empty(0, np.uint32)] * len(column)
        simple = self._simple(data, offsets)
        kind = _CLASS[data]
        edge = np.empty(len(data) + 1, bool)
        edge[0], edge[-1] = True, True
        edge[1:-1] = kind[1:] != kind[:-1]
        edge[:-1] |= kind == DIGIT
        # words with an apostrophe stay whole
        quoted = np.flatnonzero(data == 0x27)
        if len(quoted):
            space = kind == SPACE
            border = np.empty(len(data) + 1, bool)
            border[0], border[-1] = True, True
            border[1:-1] = space[1:] != space[:-1]
            border[offsets] = True
            borders = np.flatnonzero(border)
            word = np.unique(np.searchsorted(borders, quoted, "right") - 1)
            first, last = borders[word], borders[word + 1]
            inner = _ranges(first + 1, last - first - 1)
            edge[inner] = False
            kind[_ranges(first, last - first)] = OTHER
        edge[offsets] = True
        cuts = np.flatnonzero(edge)
        starts, ends = cuts[:-1], cuts[1:]
        real = kind[starts] != SPACE
        starts, ends = starts[real], ends[real]
        hashes = hash_spans(data, starts, ends)
        unique, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        checks = self._checks(data, starts[where], ends[where])
        first, count = self.pieces.find(unique, checks)
        new = np.flatnonzero(first < 0)
        if len(new):
            raw = data.tobytes()
            sizes, ids = self._encoded([raw[a:b] for a, b in zip(starts[where[new]].tolist(), ends[where[new]].tolist(), strict=True)])
            base = self.pieces.used
            self.pieces.add(unique[new], checks[new], sizes, ids)
            if self.pieces.used < base + len(ids):  # some were forgotten meanwhile: places have changed
                first, count = self.pieces.find(unique, checks)
                if (first < 0).any():
                    return [self.whole(t or "") for t in column.to_pylist()]
            else:
                first[new], count[new] = base + np.cumsum(sizes) - sizes, sizes
        of_piece = count[inverse]
        ids = self.pieces.ids[_ranges(first[inverse], of_piece)]
        ends_of = np.r_[0, np.cumsum(of_piece)][np.searchsorted(starts, offsets)]
        out = [ids[a:b] for a, b in pairwise(ends_of.tolist())]
        for i in np.flatnonzero(~simple).tolist():
            out[i] = self.whole(column[i].as_py())
        return out

    @staticmethod
    def _checks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The first seven bytes of each piece and the low byte of its length."""
        out = (ends - starts).astype(np.uint64) & np.uint64(0xFF)
        for k in range(7):
            byte = data[np.minimum(starts + k, len(data) - 1)].astype(np.uint64)
            out = (out << np.uint64(8)) | np.where(starts + k < ends, byte, np.uint64(0))
        return out

    def _encoded(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each piece has, and all ids."""
        merge = self.tokenizer.model.tokenize
        found: list = [None] * len(pieces)
        plain = [i for i, p in enumerate(pieces) if p.isascii() and p.isalpha()]
        for i in plain:
            found[i] = [t.id for t in merge(pieces[i].decode())]
        letters = [i for i, p in enumerate(pieces) if found[i] is None and len(p) <= LONG and p.decode("utf-8", "replace").isalpha()]
        if letters:
            low = self.tokenizer.normalizer.normalize_str(b" ".join([pieces[i] for i in letters]).decode())
            if len(low.split(" ")) == len(letters):
                spelt = self.mapped(low)[0][0].split(self.mapped(" ")[0][0])
                for i, word, p in zip(letters, low.split(" "), spelt, strict=True):
                    if word.isalpha():
                        found[i] = [t.id for t in merge(p)]
        for i, p in enumerate(pieces):
            if found[i] is None:
                # a piece of a text that is encoded whole may not even be a text
                found[i] = self.whole(p.decode("utf-8", "replace")).tolist()
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return sizes, np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))


def text_ids(path: str) -> TextIds:
    """One reader for each worker process and vocabulary."""
    return per_process(f"text ids of {path}", lambda: TextIds(path))


def _pieces_of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of bounded numbers of rows and, but for single texts, of bytes."""
    for part in slices(batches, DOCS_AT_ONCE):
        _, offsets = text_bytes(part.column(1))
        start = 0
        while start < part.num_rows:
            end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + BYTES_AT_ONCE, "right")) - 1)
            yield part.slice(start, end - start)
            start = end


def tier_of(length: int, window: int = WINDOW) -> int:
    """The shortest power of two that holds ``length``, ``window`` at most."""
    return min(window, 1 << max(0, length - 1).bit_length())


def pack(lengths: list[int], window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length); each sums to a power of two."""
    out = [[(d, s, window)] for d, n in enumerate(lengths) for s in range(0, n - window + 1, window)]
    rests = sorted((n % window, d, n - n % window) for d, n in enumerate(lengths) if n % window)
    while rests:
        n, d, start = rests.pop()
        sequence, tier = [(d, start, n)], tier_of(n, window)
        gap = tier - n
        while gap and rests:
            at = bisect_right(rests, (gap, len(lengths), 0))
            if at:
                n, d, start = rests.pop(at - 1)
                sequence.append((d, start, n))
                gap -= n
            else:  # the shortest left is longer than the gap: cut it
                n, d, start = rests.pop(0)
                sequence.append((d, start, gap))
                insort(rests, (n - gap, d, start + gap))
                gap = 0
        if not gap:
            out.append(sequence)
            continue
        whole = tier - gap  # nothing fills the gap: cut the sequence at powers of two
        while whole:
            size = 1 << (whole.bit_length() - 1)
            part, room = [], size
            while room:
                d, start, n = sequence.pop(0)
                part.append((d, start, min(n, room)))
                if n > room:
                    sequence.insert(0, (d, start + room, n - room))
                room -= min(n, room)
            out.append(part)
            whole -= size
    return out


def step_groups(totals: list[int], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A step group for each sequence: longest first, to the emptiest group."""
    import heapq

    heap = [(0, g) for g in range(max(1, -(-sum(totals) // step_tokens)))]
    groups = [0] * len(totals)
    for i in sorted(range(len(totals)), key=lambda i: -totals[i]):
        held, g = heap[0]
        groups[i] = g
        heapq.heapreplace(heap, (held + totals[i], g))
    return groups


def pack_documents(docs: DataFrame, tokenizer_path: str, *, window: int = WINDOW, end_id: int = END_ID,
                   chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, tier (tokens of the sequence) and step_group."""
    docs = docs.select("doc_id", "text")
    longs = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group")
    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(n, T.LongType()) for n in longs]])
    end = np.uint32(end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = text_ids(tokenizer_path)
        sequence_id, step = (TaskContext.get().partitionId() << 36,) * 2

        def flush(held: list[tuple[object, np.ndarray]], kind: pa.DataType):
            nonlocal sequence_id, step
            sequences = pack([len(ids) for _, ids in held], window)
            groups = step_groups([sum(n for *_, n in s) for s in sequences])
            rows: list[tuple] = []
            for sequence, group in zip(sequences, groups, strict=True):
                offset, tier = 0, sum(n for *_, n in sequence)
                for d, start, n in sequence:
                    doc_id, ids = held[d]
                    rows.append((doc_id, start, n, zlib.crc32(ids[start:start + n]), len(ids),
                                 sequence_id, offset, tier, step + group))
                    offset += n
                sequence_id += 1
            step += max(groups, default=-1) + 1
            for i in range(0, len(rows), 8192):
                columns = zip(*rows[i:i + 8192], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, kind if k == 0 else pa.int64()) for k, c in enumerate(columns)],
                                                 ["doc_id", *longs])

        held, tokens, kind = [], 0, None
        for part in _pieces_of_batches(batches):
            kind = part.schema.field(0).type
            for doc_id, ids in zip(part.column(0).to_pylist(), ids_of.batch(part.column(1)), strict=True):
                held.append((doc_id, np.append(ids, end).astype("<u4", copy=False)))
                tokens += len(held[-1][1])
                if tokens >= chunk_tokens:
                    yield from flush(held, kind)
                    held, tokens = [], 0
        if held:
            yield from flush(held, kind)

    return docs.mapInArrow(run, schema)
