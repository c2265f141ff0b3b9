"""MinHash near-dedup by an inverted join over signature coordinates.

Documents with the same shingle set form a class; its least doc_id stands for
it. Each class gets a signature of K minima and is posted under every
(coordinate, value) pair. Pairs of classes that agree in at least MATCHES
coordinates are candidates, and links are confirmed on full shingle sets.

Counting collisions without meeting everywhere:

* a posting that no other class shares is dropped, and with it every class that
  has fewer than MATCHES postings left;
* prefix: a class's postings are ordered by length of their lists, shortest
  first. Two classes that agree MATCHES times meet in the first
  (shared - MATCHES + 1) of both, so only those lists are merged, which leaves
  out the long lists of passages that many documents share;
* skip: first the members of each list meet the list's leader only. What the
  confirmed links have joined does not meet again: the merge of the lists pairs
  members of different components, and of set sizes that allow a link, only.
  Long lists are merged block by block. A task counts the collisions of a
  pair in the first list that both have, and compares the sketches of pairs that
  collide often enough (the SKETCH least shingle hashes, which for shorter sets are
  the set itself), so that few pairs without a link leave it.

K = 64 and MATCHES = 30: a pair of likeness 0.75 misses with chance below 1e-6;
five standard errors below 0.75 a sketch still lets it pass.

Defined edge cases: without words (null, empty or white space) a document has no
set and is linked with nothing; fewer than five words are one shingle; a doc_id
that occurs more than once is one document, linked if any of its texts is; rows
without a doc_id are linked with nothing and kept, their component is null; an
empty table gives an empty result; further columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import cut, groups, release, slices
from quarry.llm.components import components
from quarry.llm.shingles import Shingler, odd_constants

K, MATCHES = 64, 30
LIKENESS = 75  # per cent
LEADER_ROUNDS = 1
BLOCK = 2000  # members of a list that meet in one block
SKETCH = 512  # shingle hashes
ROWS = 1 << 15  # shingles hashed at a time


def signature(hashes: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The K 32-bit minima of a set of shingle hashes."""
    out = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), ROWS):
        out = np.minimum(out, (hashes[i:i + ROWS, None] * factors + offsets).min(axis=0))
    return (out >> np.uint64(32)).astype(np.uint32)


def signatures(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, n_shingles, digest of the set, signature (null without words)."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_shingles", T.LongType()),
                           T.StructField("digest", T.BinaryType()), T.StructField("signature", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, factors, offsets = Shingler(), odd_constants(k, 11), odd_constants(k, 13)
        for part in slices(batches):
            counts, digests, signed = [], [], []
            for found in map(np.unique, of.of(part.column(1))):
                counts.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                signed.append(signature(found, factors, offsets).view(np.int32) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(signed, pa.list_(pa.int32()))], ["doc_id", "n_shingles", "digest", "signature"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def shingle_sets(docs: DataFrame, sketch: int = SKETCH) -> DataFrame:
    """doc_id, shingles (the sorted full set), sketch (its least hashes, 32 bits of each)."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("shingles", T.ArrayType(T.LongType())),
                           T.StructField("sketch", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Shingler()
        for part in slices(batches):
            sets = list(map(np.unique, of.of(part.column(1))))
            least = [np.unique((x[:sketch] >> np.uint64(32)).astype("<u4")).tobytes() for x in sets]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64())),
                                              pa.array(least, pa.binary())], ["doc_id", "shingles", "sketch"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def sketch_likeness(a: np.ndarray, b: np.ndarray, size: int = SKETCH) -> tuple[float, bool]:
    """The likeness of two sets by their sketches, and whether it is exact."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    new = np.r_[True, both[1:] != both[:-1]]
    shared, union = both[~new], both[new]
    if len(a) < size and len(b) < size:
        return len(shared) / len(union), True
    union = union[:size]
    return np.count_nonzero(shared <= union[-1]) / len(union), False


def posting_lists(classes: DataFrame, matches: int = MATCHES) -> DataFrame:
    """rep, size, signature and tokens: the shared postings of every class that has
    ``matches`` of them, shortest list first, and ``prefix``, how many of them are merged."""
    posted = (classes.select("rep", F.posexplode("signature").alias("coordinate", "value"))
              .select("rep", (F.shiftleft(F.col("coordinate").cast("long"), 32)
                              + F.col("value").cast("long") + F.lit(1 << 31)).alias("token")))
    lengths = posted.groupBy("token").agg(F.count("*").alias("members")).where("members > 1")
    shared = (posted.join(lengths, "token").groupBy("rep")
              .agg(F.sort_array(F.collect_list(F.struct("members", "token"))).alias("shared"))
              .where(F.size("shared") >= matches)
              .select("rep", F.col("shared.token").alias("tokens"), (F.size("shared") - matches + 1).alias("prefix")))
    return shared.join(classes.select("rep", "size", "signature"), "rep")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are alike enough."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(left, "a").join(right, "b")
            .where(100 * both >= percent * (F.size("sa") + F.size("sb") - both)).select("a", "b").distinct())


def _collide(pairs: DataFrame, lists: DataFrame, matches: int, percent: int) -> DataFrame:
    """The pairs that agree in at least ``matches`` coordinates and could be alike by their sizes."""
    left = lists.select(F.col("rep").alias("a"), F.col("tokens").alias("ta"), F.col("size").alias("na"))
    right = lists.select(F.col("rep").alias("b"), F.col("tokens").alias("tb"), F.col("size").alias("nb"))
    return (pairs.join(left, "a").join(right, "b")
            .where((100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
                   & (F.size(F.array_intersect("ta", "tb")) >= matches)).select("a", "b"))


def _members(lists: DataFrame, found: DataFrame) -> DataFrame:
    """token, rep, component for the merged lists that still hold more than one component."""
    known = (lists.join(found.withColumnRenamed("node", "rep"), "rep", "left")
             .withColumn("component", F.coalesce("component", "rep"))
             .select("rep", "component", F.explode(F.slice("tokens", 1, F.col("prefix"))).alias("token")))
    open_lists = (known.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                  .where("lo < hi").select("token"))
    return known.join(open_lists, "token", "left_semi")


def _led(members: DataFrame, turn: int) -> DataFrame:
    """Each member with the leader of its list, if not yet in one component."""
    rank = F.col("rep") if turn == 0 else F.xxhash64("rep", "token", F.lit(turn))
    leaders = members.groupBy("token").agg(F.min_by(F.struct("rep", "component"), rank).alias("leader"))
    return (members.join(leaders, "token").where(F.col("leader.component") != F.col("component"))
            .select(F.least("rep", "leader.rep").alias("a"), F.greatest("rep", "leader.rep").alias("b")).distinct())


def _pairs_of_list(rows: dict, matches: int, percent: int) -> Iterator[tuple[int, int]]:
    """The pairs of one block of a list that collide often enough, have their first
    common merged list here, and are alike by their sketches."""
    order = np.argsort(np.array(rows["size"]), kind="stable")
    size, rep = np.array(rows["size"])[order], np.array(rows["rep"], np.int64)[order]
    component, slot = np.array(rows["component"], np.int64)[order], np.array(rows["slot"])[order]
    merged = np.array(rows["merged"], np.int64).view(np.uint64)[order]
    signature = np.array(rows["signature"], np.int32)[order]
    sketch = [np.frombuffer(rows["sketch"][i], "<u4") for i in order]
    here = np.uint64(1) << np.uint64(rows["token"][0] >> 32)
    across = rows["i"][0] != rows["j"][0]
    slack = 5 * 0.5 / np.sqrt(SKETCH)
    last = np.searchsorted(size, size * 100 // percent, "right")  # sizes that can still be alike
    for x in range(len(rep) - 1):
        found = slice(x + 1, last[x])
        agree = signature[found] == signature[x]
        near = (agree.sum(axis=1) >= matches) & (component[found] != component[x])
        if across:
            near &= slot[found] != slot[x]
        near = np.flatnonzero(near)
        if not len(near):
            continue
        bits = np.packbits(agree[near], axis=1, bitorder="little").view("<u8").ravel() & merged[x] & merged[found][near]
        for y in (near[(bits & (~bits + np.uint64(1))) == here] + x + 1).tolist():
            likeness, exact = sketch_likeness(sketch[x], sketch[y])
            if likeness >= percent / 100 - (1e-9 if exact else slack):
                yield int(min(rep[x], rep[y])), int(max(rep[x], rep[y]))


def _merged(members: DataFrame, lists: DataFrame, sets: DataFrame, matches: int, percent: int) -> DataFrame:
    """The candidate pairs of different components from all open lists; a long list is
    split into blocks, and each two of its blocks meet in a task."""
    blocks = members.groupBy("token").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    bit = lambda t: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(t, 32).cast("int"))
    known = (lists.select("rep", "size", "signature", F.aggregate(F.slice("tokens", 1, F.col("prefix")), F.lit(0).cast("long"),
                                                                  lambda a, t: a.bitwiseOR(bit(t))).alias("merged"))
             .join(sets.select(F.col("doc_id").alias("rep"), "sketch"), "rep"))
    slot = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    met = (members.join(blocks, "token").withColumn("slot", slot)
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .select("token", F.least("slot", "other").alias("i"), F.greatest("slot", "other").alias("j"), "slot", "rep", "component")
           .join(known, "rep").repartition("token", "i", "j").sortWithinPartitions("token", "i", "j"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, ["token", "i", "j"]):
            found = list(zip(*_pairs_of_list(rows, matches, percent), strict=True)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], ["a", "b"])

    return met.mapInArrow(run, "a long, b long").distinct()


def near_links(docs: DataFrame, lists: DataFrame, *, matches: int = MATCHES, percent: int = LIKENESS) -> DataFrame:
    """a, b: links between classes that connect what is alike, each confirmed
    on full sets. Classes already connected are not linked again."""
    lists = cut(lists, "minhash-lists")
    sets = cut(shingle_sets(docs.join(lists.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")), "minhash-sets")
    links = lists.sparkSession.createDataFrame([], "a long, b long")
    found = lists.select(F.col("rep").alias("node"), F.col("rep").alias("component")).limit(0)
    for turn in range(LEADER_ROUNDS + 1):
        members = cut(_members(lists, found), "minhash-members")
        if members.isEmpty():
            break
        pairs = (_collide(_led(members, turn), lists, matches, percent) if turn < LEADER_ROUNDS
                 else _merged(members, lists, sets, matches, percent))
        fresh = cut(_confirm(pairs, sets, percent), "minhash-links")
        links = links.unionByName(fresh)
        if turn < LEADER_ROUNDS:
            found = components(links)
            release(links.sparkSession)
    return links


def near_groups(docs: DataFrame, *, k: int = K, matches: int = MATCHES, percent: int = LIKENESS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``."""
    release(docs.sparkSession)
    signed = cut(signatures(docs.withColumn("doc_id", F.col("doc_id").cast("long")), k), "minhash-signatures")
    classes = (signed.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("rep")))
    rows = signed.select("doc_id", "n_shingles", "digest").join(classes, "digest", "left")
    stand_ins = (signed.join(classes, "digest").where("doc_id = rep")
                 .select("rep", F.col("n_shingles").cast("int").alias("size"), "signature"))
    links = near_links(docs, posting_lists(stand_ins, matches), matches=matches, percent=percent)
    # a doc_id with several texts is one node
    several = (rows.where("rep IS NOT NULL").groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("hi"))
               .where("a < hi").select("doc_id", "a"))
    links = links.unionByName(rows.join(several, "doc_id").where("rep <> a").select("a", F.col("rep").alias("b")))
    release(docs.sparkSession)
    found = components(links).withColumnRenamed("node", "rep")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return (rows.join(found, "rep", "left")
            .select("doc_id", "n_shingles", component.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each group."""
    gone = near_groups(docs, **options).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
