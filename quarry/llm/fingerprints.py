"""Document fingerprints: one-permutation MinHash, optimal densification, b bits.

Every shingle is hashed once; the leading bits choose its bin, the rest
compete for the bin's minimum. An empty bin takes the value of the first filled
bin along its own fixed random sequence of bins, the same for all documents,
so that equal sets fill alike and a bin of two documents agrees with the
chance of their Jaccard likeness. The low ``BITS`` bits of the minima are packed
into the fingerprint. Likeness is the share of agreeing bins, corrected for the
chance of 2**-BITS that different minima agree.

Defined edge cases: a text without words (null, empty or white space) has the
empty fingerprint "", of likeness 1 to itself and 0 to all others; fewer than five
words make one shingle; very long texts are hashed whole; rows that repeat a doc_id
are documents of their own, ordered by text; rows without a doc_id come last; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import slices
from quarry.llm.shingles import Shingler, mixed, odd_constants

BINS, BITS = 512, 4
PROBES = 64


class Fingerprinter:
    def __init__(self, bins: int = BINS, bits: int = BITS):
        self.bins, self.bits, self.shingler = bins, bits, Shingler()
        self.shift = np.uint64(64 - int(bins).bit_length() + 1)
        self.low = np.uint64((1 << bits) - 1)
        self.salt = odd_constants(bins, 23)
        self.probes: list[np.ndarray] = []

    def _probe(self, block: int) -> np.ndarray:
        """Rows of bins to try, PROBES of them for every bin."""
        while len(self.probes) <= block:
            n = len(self.probes) * PROBES
            at = np.arange(n, n + PROBES, dtype=np.uint64)[:, None] * np.uint64(self.bins) + np.arange(self.bins, dtype=np.uint64)
            self.probes.append((mixed(at + np.uint64(0x9E3779B97F4A7C15)) % np.uint64(self.bins)).astype(np.int64))
        return self.probes[block]

    def minima(self, hashes: np.ndarray) -> np.ndarray | None:
        """The densified bins, None for a text without words."""
        if not len(hashes):
            return None
        out = np.full(self.bins, np.iinfo(np.uint64).max, np.uint64)
        place = (hashes >> self.shift).astype(np.int64)
        np.minimum.at(out, place, mixed(hashes))
        filled = np.zeros(self.bins, bool)
        filled[place] = True
        if filled.sum() == 1:
            return np.full(self.bins, out[place[0]])
        empty, block, source = np.flatnonzero(~filled), 0, np.arange(self.bins)
        while len(empty):
            tries = self._probe(block)[:, empty]
            hit = filled[tries]
            first = hit.argmax(axis=0)
            found = hit.any(axis=0)
            source[empty[found]] = tries[first[found], np.flatnonzero(found)]
            empty, block = empty[~found], block + 1
        return out[source]

    def low_bits(self, text: str | None) -> np.ndarray | None:
        return self._low(self.shingler.hashes(text))

    def low_bits_of(self, column: pa.Array) -> list[np.ndarray | None]:
        return list(map(self._low, self.shingler.of(column)))

    def _low(self, hashes: np.ndarray) -> np.ndarray | None:
        minima = self.minima(hashes)
        if minima is None:
            return None
        # hashed once more with the bin: bins that share a minimum must not agree by chance together
        return (mixed(minima + self.salt) & self.low).astype(np.uint8)

    def packed(self, low: np.ndarray | None) -> str:
        if low is None:
            return ""
        bits = np.unpackbits(low[:, None], axis=1, count=self.bits, bitorder="little")
        return np.packbits(bits.ravel(), bitorder="little").tobytes().hex()

    def likeness(self, a: np.ndarray | None, b: np.ndarray | None) -> float:
        if a is None or b is None:
            return float(a is b)
        chance = 2.0 ** -self.bits
        return float(min(1.0, max(0.0, ((a == b).mean() - chance) / (1 - chance))))


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as much of the front of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def with_following(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """doc_id, text dealt to id ranges in ascending order, each range ended by
    the first document of the one after it (``extra``). One shuffle: the
    range limits come from approximate quantiles of the ids, the first ids of
    the ranges (one per range) are all that reaches the driver."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    limits = sorted(set(docs.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.2 / n))) if n > 1 else []
    range_of = F.when(F.col("doc_id").isNull(), F.lit(len(limits) + 1)).otherwise(
        F.size(F.filter(F.array(*[F.lit(int(x)) for x in limits]).cast("array<long>"), lambda x: x <= F.col("doc_id")))).cast("int")
    dealt = docs.withColumn("range", range_of).withColumn("extra", F.lit(False))
    firsts = {r["range"]: r["doc_id"] for r in dealt.groupBy("range").agg(F.min("doc_id").alias("doc_id")).collect()}
    if not firsts:
        return dealt
    used = sorted(firsts)
    before = {r: used[i - 1] for i, r in enumerate(used)}  # the last range is followed by the first
    # the first document of a range is the least text among the rows of its first id
    pairs = F.create_map(*[F.lit(x) for r in used for x in (r, before[r])])
    starts = F.create_map(*[x for r in used for x in (F.lit(r), F.lit(firsts[r]).cast("long"))])
    heads = (dealt.where(F.col("doc_id").eqNullSafe(starts[F.col("range")]))
             .groupBy("range").agg(F.min_by(F.struct("doc_id", "text"), "text").alias("head"))
             .select("head.doc_id", "head.text", pairs[F.col("range")].alias("range"), F.lit(True).alias("extra")))
    return (dealt.unionByName(heads).repartition(n, "range")
            .sortWithinPartitions("range", "extra", F.col("doc_id").asc_nulls_last(), "text"))


def fingerprint_report(docs: DataFrame, *, bins: int = BINS, bits: int = BITS,
                       partitions: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next for every row."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()),
                           *[T.StructField(n, T.StringType()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")],
                           *[T.StructField(n, T.DoubleType()) for n in ("near_edited", "near_next")]])
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Fingerprinter(bins, bits)
        held = None  # the row that waits for its follower: range, doc_id, text, low bits
        for part in slices(batches):
            rows = []
            for doc_id, text, group, extra, low in zip(*(part.column(n).to_pylist() for n in ("doc_id", "text", "range", "extra")),
                                                       of.low_bits_of(part.column("text")), strict=True):
                if held:
                    _, old_id, old_text, old = held
                    new_text = edited(old_text, text)
                    new = of.low_bits(new_text)
                    rows.append((old_id, len(old_text), hashlib.sha256(new_text.encode()).hexdigest(), of.packed(old),
                                 of.packed(new), of.likeness(old, new), of.likeness(old, low)))
                held = None if extra else (group, doc_id, text, low)
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return with_following(docs, partitions).mapInArrow(run, schema)


def fingerprints(docs: DataFrame, *, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """doc_id, fingerprint: one narrow pass."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("fingerprint", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Fingerprinter(bins, bits)
        for part in slices(batches):
            out = [of.packed(low) for low in of.low_bits_of(part.column(1))]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.string())], ["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)
