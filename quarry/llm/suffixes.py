"""Substring dedup by suffix sorting: multikey quicksort, then blind tries.

Every byte that lies in a LENGTH-byte string which also starts anywhere else is
removed. Comparing all suffixes of a corpus would shuffle many times its size, so
suffixes are sorted around anchors only: in each window of LENGTH bytes the GRAM-byte
substring of least hash is an anchor. Equal windows have equal anchors, so
every repeated window is found at an anchor that it shares.

1. Two Bloom filters over the grams at the anchors drop anchors whose gram occurs once.
2. The others send their surroundings (all that a window through the anchor can
   cover, on either side) to the task of their gram; equal surroundings are
   counted in the map task first, so copies cost one row per task.
3. A task sorts the right sides, and the reversed left sides, of its grams: multikey
   quicksort by eight bytes at a time to a shallow depth, then a blind trie for
   each group that still has a common prefix. Two surroundings share the
   window that starts o bytes before the anchor exactly if they agree in o bytes
   to the left and in the rest to the right, which the sorted orders and their
   common prefix lengths answer for all o.
4. Grams with more than GROUP_ROWS different surroundings leave the task as they
   came; their windows are counted by a distributed aggregate instead.
5. What each anchor covers returns to its document, and the union of it is cut out.

Defined edge cases: null and empty texts have no bytes; texts are bytes of
UTF-8 and what is left need not be valid UTF-8 (the kept bytes are hashed); matches
never cross rows; rows that repeat a doc_id, or lack one, are texts of their own
(equal rows are copies of each other); very long texts are read in overlapping pieces;
an empty table gives an empty result; further columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import bloom
from quarry.llm.common import cut, per_process, slices
from quarry.llm.shingles import mixed, odd_constants

LENGTH, GRAM = 200, 64
SIDE = LENGTH - GRAM  # bytes of a window on either side of the gram at most
LOG2_BITS = 28
PIECE = 1 << 18  # bytes hashed at a time
SHALLOW = 4  # words of eight bytes
GROUP_ROWS = 20_000  # different surroundings of a gram that one task sorts
BATCH_ROWS = 30_000  # surroundings sorted together
HELD_CONTEXTS = 50_000  # surroundings counted in a map task before they are sent

_BASE = odd_constants(1, 17)[0]
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _ladders() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse."""
    return per_process("suffix powers", lambda: (_powers(_BASE, PIECE + LENGTH + 1), _powers(_INVERSE, PIECE + LENGTH + 1)))


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A mixed 64-bit hash of the GRAM bytes from each position on."""
    up, down = _ladders()
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=sums[1:])
    return mixed((sums[GRAM:] - sums[:-GRAM]) * down[:len(sums) - GRAM])


def _slide(values: np.ndarray, width: int, best: np.ufunc, pad: int) -> np.ndarray:
    """best over each run of ``width`` values (as many as there are full runs)."""
    n = len(values)
    full = np.full(-(-n // width) * width, pad, np.uint64)
    full[:n] = values
    blocks = full.reshape(-1, width)
    ahead = best.accumulate(blocks, axis=1).ravel()
    back = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(back[:n - width + 1], ahead[width - 1:n])


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """text, position, gram hash of every anchor, texts of at least LENGTH bytes only."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    held: list[tuple[int, int, bytes]] = []

    def run():
        raw = np.frombuffer(b"".join(p for *_, p in held), np.uint8)
        ends = np.cumsum([len(p) for *_, p in held])
        starts = np.r_[0, ends[:-1]]
        hashes = gram_hashes(raw)
        width = SIDE + 1
        least = _slide(hashes, width, np.minimum, (1 << 64) - 1)  # by window start
        inside = np.zeros(len(least), bool)
        for a, b in zip(starts, ends, strict=True):
            inside[a:b - LENGTH + 1] = True
        least[~inside] = 0
        # a gram is an anchor if some window through it has it as its least
        reach = _slide(np.r_[np.zeros(SIDE, np.uint64), least, np.zeros(SIDE, np.uint64)], width, np.maximum, 0)
        at = np.flatnonzero((hashes == reach) & (reach != 0))
        piece = np.searchsorted(ends, at, "right")
        owner = np.array([o for o, *_ in held])[piece]
        offset = np.array([s for _, s, _ in held])[piece]
        found.append((owner, at - starts[piece] + offset, hashes[at]))

    size = 0
    for i, text in enumerate(texts):
        for start in range(0, max(1, len(text) - LENGTH + 1), PIECE - LENGTH + 1):
            piece = text[start:start + PIECE]
            if len(piece) < LENGTH:
                continue
            if size + len(piece) > PIECE and held:
                run()
                held, size = [], 0
            held.append((i, start, piece))
            size += len(piece)
    if held:
        run()
    if not found:
        empty = np.empty(0, np.int64)
        return empty, empty, np.empty(0, np.uint64)
    owner, at, gram = (np.concatenate(x) for x in zip(*found, strict=True))
    if any(len(t) > PIECE for t in texts):  # the pieces of a text overlap
        _, once = np.unique(np.stack([owner, at], axis=1), axis=0, return_index=True)
        return owner[once], at[once], gram[once]
    return owner, at, gram


def _around(text: bytes, at: int) -> tuple[int, bytes]:
    """Bytes left of the anchor (SIDE at most), and all from there to LENGTH past it."""
    left = min(at, SIDE)
    return left, text[at - left:at + LENGTH]


def _key(left: int, around: bytes) -> bytes:
    return hashlib.blake2b(around, digest_size=16, salt=left.to_bytes(2, "little")).digest()


class BlindTrie:
    """Distinct byte strings of equal length, in order. Inner nodes know only
    the depth at which their strings differ and the bytes there."""

    def __init__(self, strings: list[bytes]):
        self.root: list | bytes = strings[0]
        for s in strings[1:]:
            self._insert(s)

    def _insert(self, s: bytes) -> None:
        node = self.root
        while isinstance(node, list):  # blindly to some leaf
            node = node[1].get(s[node[0]]) or next(iter(node[1].values()))
        depth = _common(s, node)
        parent, node = None, self.root
        while isinstance(node, list) and node[0] < depth:
            parent, node = node, node[1][s[node[0]]]
        if isinstance(node, list) and node[0] == depth:
            node[1][s[depth]] = s
            return
        some = node
        while isinstance(some, list):
            some = next(iter(some[1].values()))
        split = [depth, {some[depth]: node, s[depth]: s}]
        if parent is None:
            self.root = split
        else:
            parent[1][s[parent[0]]] = split

    def ordered(self) -> Iterator[bytes]:
        stack = [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, bytes):
                yield node
            else:
                stack.extend(node[1][b] for b in sorted(node[1], reverse=True))


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix of two different strings of one length."""
    lo, hi = 0, len(a)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def deep_shallow(group: np.ndarray, strings: np.ndarray) -> np.ndarray:
    """The order of rows by (group, string); ``strings`` is a byte matrix."""
    n, width = strings.shape
    words = np.ascontiguousarray(strings).view(">u8").astype(np.uint64)
    order = np.argsort(group, kind="stable")
    cls = np.cumsum(np.r_[0, group[order][1:] != group[order][:-1]]) if n else np.empty(0, int)
    for depth in range(min(SHALLOW, words.shape[1])):
        size = np.bincount(cls)
        open_rows = np.flatnonzero(size[cls] > 1)  # places in ``order``
        if not len(open_rows):
            return order
        rows = order[open_rows]
        by = np.lexsort((words[rows, depth], cls[open_rows]))
        order[open_rows] = rows[by]
        word = words[order, depth]
        cls = np.cumsum(np.r_[0, (cls[1:] != cls[:-1]) | (word[1:] != word[:-1])])
    # classes that share more than the shallow depth
    starts = np.flatnonzero(np.r_[True, cls[1:] != cls[:-1]])
    ends = np.r_[starts[1:], n]
    raw, skip = strings.tobytes(), 8 * SHALLOW
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        if b - a < 2:
            continue
        held: dict[bytes, list[int]] = {}
        for i in order[a:b].tolist():
            held.setdefault(raw[i * width + skip:(i + 1) * width], []).append(i)
        if len(held) > 1:
            order[a:b] = [i for s in BlindTrie(list(held)).ordered() for i in held[s]]
    return order


def _classes(group: np.ndarray, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each row, and the common prefix of each row of the order with the one before (-1 across groups)."""
    order = deep_shallow(group, strings)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    common = np.full(len(order), -1)
    for i in range(1, len(order), 1 << 14):
        here, before = order[i:i + (1 << 14)], order[i - 1:i - 1 + (1 << 14)]
        before = before[:len(here)]
        differ = strings[here] != strings[before]
        same = np.where(differ.any(axis=1), differ.argmax(axis=1), strings.shape[1])
        common[i:i + len(here)] = np.where(group[here] == group[before], same, -1)
    return rank, common


def shared_windows(group: np.ndarray, left: np.ndarray, around: list[bytes], count: np.ndarray):
    """For rows of (gram, surroundings, how often): the least and the largest
    start before the anchor of a window that occurs elsewhere (least > largest: none)."""
    n = len(around)
    right = np.array([len(a) for a in around]) - left  # from the anchor on
    low, high = np.maximum(0, LENGTH - right), left.copy()  # windows that fit the text
    least, largest = np.full(n, LENGTH), np.full(n, -1)
    copies = (count > 1) & (low <= high)
    least[copies], largest[copies] = low[copies], high[copies]
    # groups of one row have nothing to compare with, groups of copies are done
    size, todo = np.bincount(group), np.bincount(group, ~copies)
    rows = np.flatnonzero((size[group] > 1) & (todo[group] > 0))
    if not len(rows):
        return least, largest
    m = len(rows)
    after = np.zeros((m, SIDE), np.uint8)
    before = np.zeros((m, SIDE), np.uint8)
    for k, i in enumerate(rows.tolist()):
        a, l = around[i], int(left[i])
        tail = np.frombuffer(a, np.uint8)[l + GRAM:]
        after[k, :len(tail)] = tail
        before[k, :l] = np.frombuffer(a, np.uint8)[:l][::-1]
    g, lo, hi = group[rows], low[rows], high[rows]
    rank_r, common_r = _classes(g, after)
    rank_l, common_l = _classes(g, before)
    for o in range(SIDE + 1):
        fits = np.flatnonzero((lo <= o) & (o <= hi))
        if len(fits) < 2:
            continue
        right_class = np.cumsum(common_r < SIDE - o)[rank_r[fits]]
        left_class = np.cumsum(common_l < o)[rank_l[fits]]
        key = right_class * (m + 1) + left_class
        by = np.argsort(key, kind="stable")
        equal = key[by][1:] == key[by][:-1]
        hit = rows[fits[by[np.r_[equal, False] | np.r_[False, equal]]]]
        least[hit] = np.minimum(least[hit], o)
        largest[hit] = np.maximum(largest[hit], o)
    return least, largest


def _suspects(texts: list[bytes], bits: np.ndarray, log2_bits: int):
    owner, at, gram = anchors(texts)
    hit = bloom.suspected(gram, bits, log2_bits)
    return zip(owner[hit].tolist(), at[hit].tolist(), gram[hit].view(np.int64).tolist(), strict=True)


def _contexts(docs: DataFrame, shared, log2_bits: int) -> DataFrame:
    """gram, place (bytes left of it), around, n: the surroundings of suspected anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        held: dict[tuple[int, int, bytes], int] = {}

        def emit():
            rows = list(held.items())
            for i in range(0, len(rows), 4096):
                part = rows[i:i + 4096]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k, _ in part], pa.int64()), pa.array([k[1] for k, _ in part], pa.int64()),
                     pa.array([k[2] for k, _ in part], pa.binary()), pa.array([n for _, n in part], pa.int64())],
                    ["gram", "place", "around", "n"])

        for part in slices(batches):
            texts = [(t or "").encode() for t in part.column(0).to_pylist()]
            for owner, at, gram in _suspects(texts, bits, log2_bits):
                key = (gram, *_around(texts[owner], at))
                held[key] = held.get(key, 0) + 1
            if len(held) >= HELD_CONTEXTS:
                yield from emit()
                held.clear()
        yield from emit()

    return docs.select("text").mapInArrow(run, "gram long, place long, around binary, n long")


def _resolve(contexts: DataFrame, group_rows: int) -> DataFrame:
    """key, least, largest of every surroundings with a shared window; rows of
    grams that are too large for a task come back with their surroundings."""
    names = ["key", "place", "around", "least", "largest"]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
        columns = list(zip(*rows, strict=True)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: list[list] = []  # gram, {(place, around): n}
        rows = 0
        large = None  # the gram whose rows pass through

        def solve():
            group = np.repeat(np.arange(len(grams)), [len(c) for _, c in grams])
            items = [(k, n) for _, c in grams for k, n in c.items()]
            left, around = np.array([k[0] for k, _ in items], np.int64), [k[1] for k, _ in items]
            least, largest = shared_windows(group, left, around, np.array([n for _, n in items]))
            found = np.flatnonzero(least <= largest).tolist()
            for i in range(0, len(found), 8192):
                yield out([(_key(int(left[j]), around[j]), None, None, int(least[j]), int(largest[j])) for j in found[i:i + 8192]])

        def through(items):
            return out([(_key(p, a), p, a, None if n < 2 else max(0, LENGTH - len(a) + p), None if n < 2 else p) for (p, a), n in items])

        for batch in batches:
            for gram, place, around, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not grams or grams[-1][0] != gram:
                    if rows >= BATCH_ROWS:
                        yield from solve()
                        grams, rows = [], 0
                    if large != gram:
                        grams.append([gram, {}])
                held = grams[-1][1] if grams and grams[-1][0] == gram else None
                if held is None or large == gram:
                    yield through([((place, around), n)])
                    continue
                rows += (place, around) not in held
                held[place, around] = held.get((place, around), 0) + n
                if len(held) > group_rows:
                    large = gram
                    rows -= len(held)
                    grams.pop()
                    items = list(held.items())
                    for i in range(0, len(items), 4096):
                        yield through(items[i:i + 4096])
        if grams:
            yield from solve()

    return (contexts.repartition("gram").sortWithinPartitions("gram")
            .mapInArrow(run, "key binary, place long, around binary, least long, largest long"))


def _large(rows: DataFrame) -> DataFrame:
    """key, least, largest for surroundings of very frequent grams: every window
    is counted by its digest."""
    whole = rows.where("around IS NOT NULL")
    first = F.greatest(F.lit(0), F.lit(LENGTH) - F.octet_length("around") + F.col("place"))
    # the same surroundings may have come from several map tasks
    same = whole.groupBy("key").agg(F.count("*").alias("n"), F.first("place").alias("place"), F.first("around").alias("around"),
                                    F.max("least").alias("least"), F.max("largest").alias("largest"))
    windows = (same.where(first <= F.col("place"))
               .select("key", "place", F.when(F.col("n") > 1, 2).when(F.col("largest").isNotNull(), 2).otherwise(1).alias("n"), "around",
                       F.explode(F.sequence(first.cast("long"), F.col("place"))).alias("o"))
               .select("key", "o", "n", F.md5(F.substring("around", (F.col("place") - F.col("o") + 1).cast("int"), F.lit(LENGTH))).alias("window")))
    often = windows.groupBy("window", "o").agg(F.sum("n").alias("times")).where("times > 1").select("window", "o")
    return (windows.join(often, ["window", "o"]).groupBy("key").agg(F.min("o").alias("least"), F.max("o").alias("largest")))


def _row_id():
    return F.xxhash64("text")


def repeated_spans(docs: DataFrame, *, log2_bits: int = LOG2_BITS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """doc_id, row_id (hash of the text), spans [start, end) in bytes, unordered and overlapping."""
    spark = docs.sparkSession

    def hashes_of(batch: pa.RecordBatch) -> np.ndarray:
        found = [anchors([(t or "").encode() for t in part.column(0).to_pylist()])[2] for part in slices([batch])]
        return np.concatenate([*found, np.empty(0, np.uint64)])

    shared = spark.sparkContext.broadcast(bloom.twice_filter(docs.select("text"), hashes_of, log2_bits))
    resolved = cut(_resolve(_contexts(docs, shared, log2_bits), group_rows), "suffix-windows")
    windows = resolved.where("around IS NULL").select("key", "least", "largest").unionByName(_large(resolved))
    schema = T.StructType([docs.schema["doc_id"], T.StructField("row_id", T.LongType()), T.StructField("at", T.LongType()),
                           T.StructField("key", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for part in slices(batches):
            texts = [(t or "").encode() for t in part.column("text").to_pylist()]
            owners, places, keys = [], [], []
            for owner, at, _ in _suspects(texts, bits, log2_bits):
                owners.append(owner)
                places.append(at)
                keys.append(_key(*_around(texts[owner], at)))
            take = pa.array(owners, pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(take), part.column("row_id").take(take),
                                              pa.array(places, pa.int64()), pa.array(keys, pa.binary())], ["doc_id", "row_id", "at", "key"])

    found = docs.select("doc_id", "text", _row_id().alias("row_id")).mapInArrow(run, schema)
    return (found.join(windows, "key").groupBy("doc_id", "row_id")
            .agg(F.collect_list(F.struct((F.col("at") - F.col("largest")).alias("start"),
                                         (F.col("at") - F.col("least") + LENGTH).alias("end"))).alias("spans")))


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def suffix_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the SHA-256 of the kept bytes, and
    the removed spans, for every row of ``docs``."""
    docs = docs.select("doc_id", "text")
    spans = repeated_spans(docs, **options).withColumnRenamed("doc_id", "span_doc").withColumnRenamed("row_id", "span_row")
    joined = (docs.withColumn("row_id", _row_id())
              .join(spans, F.col("doc_id").eqNullSafe(F.col("span_doc")) & (F.col("row_id") == F.col("span_row")), "left")
              .select("doc_id", "text", "spans"))
    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")],
                           T.StructField("kept_sha256", T.StringType()),
                           T.StructField("removed", T.ArrayType(T.ArrayType(T.LongType())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = []
            for text, found in zip(part.column("text").to_pylist(), part.column("spans").to_pylist(), strict=True):
                raw = (text or "").encode()
                spans = _union([(s["start"], s["end"]) for s in found or ()])
                kept, last = hashlib.sha256(), 0
                for a, b in spans:
                    kept.update(raw[last:a])
                    last = b
                kept.update(raw[last:])
                rows.append((len(raw), sum(b - a for a, b in spans), len(spans), kept.hexdigest(), spans))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array([list(map(list, v)) for v in c] if k == kinds[-1] else c, k)
                                                                       for c, k in zip(columns, kinds, strict=True)]],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])

    return joined.mapInArrow(run, schema)
