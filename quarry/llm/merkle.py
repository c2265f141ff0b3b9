"""Merkle manifest of a table of documents, with Octopus multiproofs.

A row's leaf is the SHA-256 of its columns. The leaves of a source, in order of
doc_id, are the bottom of a 16-ary tree; the sources' roots, in order of source, are
the bottom of one more. Inputs are concatenated without separators, digests as hex.

1. Leaves are dealt by range, so that a partition holds consecutive leaves of
   consecutive sources; counts per (partition, source) give every leaf its index.
2. Every partition hashes the nodes that lie wholly inside it and hands over the others'
   children only, at most 30 a level, tree and partition. The rest of the trees grows
   from those, level by level.
3. A node is *covered* by a partition if one of its leaves lies below. Which siblings of
   covered nodes are not covered follows from index ranges alone: the Octopus
   multiproof, the least set of digests that proves all of a partition's leaves. A
   partition fetches this set once, by one join, hashes the covered nodes above its leaves
   (shared by all of them), and cuts every single proof out of these levels.

Text is read once, for the leaves; what moves afterwards are digests. The number of
partitions follows the number of rows (``LEAVES`` a partition), so memory is bounded.

Defined edge cases: null columns are ``-`` in the leaf; a null source comes first; rows
with equal source and doc_id follow the order of their leaves, equal rows are leaves
of their own and may stand in any order among themselves; a row without doc_id comes
first in its source and is never tampered with; empty and very long texts are ordinary
texts; an empty table gives no rows; further columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import cut

ARITY_LOG2 = 4
ARITY = 1 << ARITY_LOG2
HEX = 64  # characters of a digest
LEAVES = 1 << 19  # leaves of a partition
POS_BITS = 33  # of monotonically_increasing_id: the row's place in its partition
TOP = ""  # key of the tree over the sources; the sources' keys start with 0 or 1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _h(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields: ``-`` if null, else byte count, colon, value."""
    parts = []
    for c in fields:
        value = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, skey (sorts like the source, null first), leaf, and ``forged``: the leaf of the
    row with lower-cased text where 5 divides the CRC of its doc_id."""
    fields = [F.col(n) for n in FIELDS]
    forged = [*fields[:-1], F.translate("text", UPPER, LOWER)]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return docs.select(
        "doc_id", F.when(F.col("source").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), "source")).alias("skey"),
        leaf_digest(fields).alias("leaf"), F.when(chosen, leaf_digest(forged)).alias("forged"))


def covered(lo: int, hi: int, n: int) -> Iterator[tuple[int, int, int, int, int]]:
    """For the leaves lo..hi-1 of a tree of n: level, the range of covered nodes, the
    range of these and their siblings. Ends below the root."""
    level = 0
    while n > 1:
        first = lo >> ARITY_LOG2 << ARITY_LOG2
        end = min(n, -(-hi // ARITY) * ARITY)
        yield level, lo, hi, first, end
        lo, hi, n, level = lo >> ARITY_LOG2, -(-hi // ARITY), -(-n // ARITY), level + 1


def _parents(nodes: bytes) -> bytes:
    step = HEX * ARITY
    return b"".join([_h(nodes[i:i + step]) for i in range(0, len(nodes), step)])


def _runs(nodes: list[bytes] | bytes, lo: int, n: int) -> Iterator[tuple[int, int, bytes, int]]:
    """Level by level: the nodes of a contiguous range whose parents are not all in it.
    Yields level, index, digest and the number of nodes of the level; the root is level -1."""
    level = 0
    data = bytes(nodes)
    hi = lo + len(data) // HEX
    while hi > lo:
        if n == 1:
            yield -1, 0, data, 1
            return
        first = min(hi, -(-lo // ARITY) * ARITY)
        last = hi if hi == n else max(first, hi >> ARITY_LOG2 << ARITY_LOG2)
        for i in [*range(lo, first), *range(last, hi)]:
            yield level, i, data[(i - lo) * HEX:(i - lo + 1) * HEX], n
        if first >= last:  # no whole run in the range
            return
        data = _parents(data[(first - lo) * HEX:(last - lo) * HEX])
        lo, hi, n, level = first // ARITY, -(-last // ARITY), -(-n // ARITY), level + 1


class _Level:
    """The digests of consecutive nodes, from index ``first``."""

    def __init__(self, first: int, data: bytes):
        self.first, self.data = first, data

    def siblings(self, i: int) -> tuple[bytes, bytes]:
        """What stands before and after node i in its run of sixteen."""
        at = (i - self.first) * HEX
        start = ((i >> ARITY_LOG2 << ARITY_LOG2) - self.first) * HEX
        return self.data[start:at], self.data[at + HEX:start + HEX * ARITY]


def _levels(lo: int, nodes: bytes, n: int, fetched: dict) -> tuple[list[_Level], bytes]:
    """All covered levels with their siblings, and the root, from the nodes lo.. of a tree
    and the fetched siblings by (level, index)."""
    out = []
    for level, a, b, first, end in covered(lo, lo + len(nodes) // HEX, n):
        nodes = (b"".join([fetched[level, i] for i in range(first, a)]) + nodes
                 + b"".join([fetched[level, i] for i in range(b, end)]))
        out.append(_Level(first, nodes))
        nodes = _parents(nodes)
    return out, nodes


def _fold(digest: bytes, i: int, levels: list[_Level]) -> tuple[bytes, list[bytes]]:
    """The root above node i if its digest is ``digest``, and its siblings on the way."""
    proof = []
    for level in levels:
        before, after = level.siblings(i)
        proof += [before, after]
        digest = _h(before + digest + after)
        i >>= ARITY_LOG2
    return digest, proof


def ordered_leaves(rows: DataFrame) -> DataFrame:
    """The leaves with ``pid``, the range partition, and ``pos``, the place in it. The table
    is dealt by (skey, doc_id, leaf), equal rows by their number."""
    stored = cut(rows.withColumn("number", F.monotonically_increasing_id()), "merkle-leaves")
    spark = rows.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-stored.count() // LEAVES))
    order = ["skey", "doc_id", "leaf", "number"]
    dealt = stored.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("number")
    at = F.monotonically_increasing_id()
    return cut(dealt.withColumn("at", at).select(
        F.shiftright("at", POS_BITS).alias("pid"), (F.col("at") % F.lit(1 << POS_BITS)).alias("pos"),
        "skey", "doc_id", "leaf", "forged"), "merkle-ordered")


def source_runs(ordered: DataFrame) -> DataFrame:
    """For every (pid, skey): start and n_run (its leaves), n (the source's), rank (the
    source's index in the top tree), n_top."""
    counts = ordered.groupBy("pid", "skey").agg(F.count("*").alias("n_run"))
    runs = counts.select("pid", "skey", "n_run", (F.coalesce(
        F.sum("n_run").over(Window.partitionBy("skey").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0))).alias("start"))
    runs = cut(runs, "merkle-runs")
    # a source is ranked in the partition where it starts; partitions are few, sources may be many
    begun = runs.where("start = 0").groupBy("pid").agg(F.count("*").alias("begun"))
    base = begun.select("pid", "begun", F.coalesce(F.sum("begun").over(
        Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    ranks = (runs.where("start = 0").join(base, "pid")
             .select("skey", (F.col("base") + F.row_number().over(Window.partitionBy("pid").orderBy("skey")) - 1).alias("rank")))
    sizes = runs.groupBy("skey").agg(F.sum("n_run").alias("n"))
    n_top = runs.where("start = 0").count()
    return cut(runs.join(ranks.join(sizes, "skey"), "skey").withColumn("n_top", F.lit(n_top).cast("long")), "merkle-ranked")


NODE = "skey string, level int, idx long, digest string, n long"


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
                                      schema=schema)


NODE_ARROW = pa.schema([("skey", pa.string()), ("level", pa.int32()), ("idx", pa.int64()), ("digest", pa.string()), ("n", pa.int64())])


def _grow(loose: DataFrame, depth: int, name: str) -> tuple[DataFrame, DataFrame]:
    """All nodes that no partition holds wholly, from the loose ones, and the trees' roots.
    ``n`` counts a tree's nodes of a row's level; ``depth``: levels of the largest tree."""
    shape = loose
    found, state = [], None
    for level in range(depth):
        here = shape.where(F.col("level") == level)
        if state is not None:
            here = here.unionByName(state)
        here = cut(here, f"{name}-{level}") if level else here
        found.append(here)
        state = (here.where("n > 1").groupBy("skey", "n", F.shiftright("idx", ARITY_LOG2).alias("parent"))
                 .agg(F.sort_array(F.collect_list(F.struct("idx", "digest"))).alias("run"))  # sixteen at most
                 .select("skey", F.lit(level + 1).alias("level"), F.col("parent").alias("idx"),
                         F.sha2(F.concat_ws("", "run.digest"), 256).alias("digest"),
                         F.ceil(F.col("n") / F.lit(ARITY)).alias("n")))
        state = state.select(*here.columns)
    roots = shape.where("level = -1").select("skey", "digest")
    for level, nodes in enumerate(found[1:], 1):
        roots = roots.unionByName(nodes.where(f"n = 1 AND level = {level}").select("skey", "digest"))
    if state is not None:
        roots = roots.unionByName(state.where("n = 1").select("skey", "digest"))
    nodes = None
    for part in found:
        part = part.select("skey", "level", "idx", "digest")
        nodes = part if nodes is None else nodes.unionByName(part)
    return nodes, roots


def _depth(n: int) -> int:
    depth = 0
    while n > 1:
        n, depth = -(-n // ARITY), depth + 1
    return depth


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified,
    source_key, leaf_index and the proof itself (hex digests, leaf level first)."""
    ordered = ordered_leaves(leaves(docs))
    return prove(ordered, source_runs(ordered))


def prove(ordered: DataFrame, runs: DataFrame) -> DataFrame:
    """Grow the trees and prove every leaf of ``ordered``."""
    spark = ordered.sparkSession
    wide = T.StructType([T.StructField("pid", T.LongType()), T.StructField("kind", T.IntegerType()),
                         T.StructField("pos", T.LongType()), T.StructField("skey", T.StringType()),
                         T.StructField("doc_id", ordered.schema["doc_id"].dataType),
                         *[T.StructField(n, T.StringType()) for n in ("leaf", "forged")],
                         *[T.StructField(n, T.LongType()) for n in ("start", "n", "rank", "n_top", "n_run")],
                         T.StructField("level", T.IntegerType()), T.StructField("idx", T.LongType()),
                         T.StructField("digest", T.StringType())])

    def shaped(df: DataFrame, kind: int) -> DataFrame:
        return df.select(*[F.lit(kind).cast("int").alias("kind") if f.name == "kind" else
                           (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wide])

    deepest, n_top, last = runs.agg(F.max("n"), F.max("n_top"), F.max("pid")).first()
    if not n_top:
        return spark.createDataFrame([], _report_schema(ordered))

    def by_partition(df: DataFrame) -> DataFrame:
        return df.repartitionById(last + 1, F.col("pid").cast("int")).sortWithinPartitions("pid", "kind", "skey", "pos")

    # each partition's own runs first, then the siblings it fetched, then its leaves in order
    told = shaped(ordered, 2).unionByName(shaped(runs, 0))

    def loose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _partitions(batches):
            rows = []
            for skey, start, n, _, _, n_run, data, _ in part.sources():
                rows += [(skey, level, i, digest.decode(), size) for level, i, digest, size in _runs(data, start, n)]
            for i in range(0, len(rows), 65536):
                yield _batch(rows[i:i + 65536], NODE_ARROW)

    hanging = cut(by_partition(told).mapInArrow(loose, NODE), "merkle-loose")
    nodes, subroots = _grow(hanging, _depth(deepest), "merkle-level")
    ranks = runs.where("start = 0").select("skey", "rank", F.col("n_top").alias("n"))
    bottom = cut(subroots.join(ranks, "skey").select(F.lit(TOP).alias("skey"), F.lit(0).alias("level"),
                                                     F.col("rank").alias("idx"), "digest", "n"), "merkle-subroots")
    top_nodes, _ = _grow(bottom, _depth(n_top), "merkle-top")
    if top_nodes is not None:
        nodes = top_nodes if nodes is None else nodes.unionByName(top_nodes)

    asked = requests(runs)
    fetched = asked if nodes is None else asked.join(nodes, ["skey", "level", "idx"])
    if nodes is None:
        fetched = fetched.withColumn("digest", F.lit(None).cast("string"))
    fetched = cut(fetched, "merkle-multiproofs")
    schema = _report_schema(ordered)
    names = [f.name for f in schema]

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _partitions(batches):
            sources = []
            for skey, start, n, rank, n_top, n_run, data, rows in part.sources():
                levels, subroot = _levels(start, data, n, part.fetched.get(skey, {}))
                sources.append((skey, start, rank, n_top, levels, subroot, rows))
            if not sources:
                continue
            # consecutive sources: the top tree's covered nodes stand side by side
            first = sources[0][2]
            above, root = _levels(first, b"".join([s[5] for s in sources]), sources[0][3], part.fetched.get(TOP, {}))
            for skey, start, rank, _, levels, subroot, rows in sources:
                folded_top, proof_top = _fold(subroot, rank, above)
                tail = b"".join(proof_top)
                at = start
                for batch in rows:
                    out: list[list] = [[] for _ in range(8)]
                    for leaf, forged in zip(batch.column("leaf").to_pylist(), batch.column("forged").to_pylist(), strict=True):
                        folded, proof = _fold((forged or leaf).encode(), at, levels)
                        folded = folded_top if folded == subroot else _fold(folded, rank, above)[0]
                        siblings = b"".join(proof) + tail
                        for c, v in zip(out, (leaf, subroot, root, _h(siblings), folded, folded == root, at, siblings), strict=True):
                            c.append(v)
                        at += 1
                    text = [pa.array(c, pa.binary()).cast(pa.string()) if i not in (0, 5, 6) else c for i, c in enumerate(out)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id"), pa.array([skey] * len(out[0]), pa.string()), pa.array(out[0], pa.string()),
                         *text[1:5], pa.array(out[5], pa.bool_()), pa.array(out[6], pa.int64()), text[7]], names)

    return by_partition(told.unionByName(shaped(fetched, 1))).mapInArrow(expand, schema)


def _report_schema(ordered: DataFrame) -> T.StructType:
    return T.StructType([ordered.schema["doc_id"], T.StructField("source_key", T.StringType()),
                         *[T.StructField(n, T.StringType()) for n in ("leaf", "subroot", "root", "proof_sha256", "folded_root")],
                         T.StructField("verified", T.BooleanType()), T.StructField("leaf_index", T.LongType()),
                         T.StructField("proof", T.StringType())])


def requests(runs: DataFrame) -> DataFrame:
    """pid, skey, level, idx: every partition's multiproof, each node once."""
    schema = pa.schema([("pid", pa.int64()), ("skey", pa.string()), ("level", pa.int32()), ("idx", pa.int64())])

    def of_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for pid, skey, start, n_run, n in zip(*(batch.column(c).to_pylist() for c in ("pid", "skey", "start", "n_run", "n")),
                                                  strict=True):
                rows += [(pid, skey, level, i) for level, a, b, first, end in covered(start, start + n_run, n)
                         for i in [*range(first, a), *range(b, end)]]
            if rows:
                yield _batch(rows, schema)

    kind = "pid long, skey string, level int, idx long"
    top = runs.groupBy("pid").agg(F.lit(TOP).alias("skey"), F.min("rank").alias("start"), F.count("*").alias("n_run"),
                                  F.max("n_top").alias("n"))
    both = runs.select("pid", "skey", "start", "n_run", "n").unionByName(top)
    return both.mapInArrow(of_runs, kind)


class _Partition:
    """One range partition: its runs, its fetched siblings, its leaves."""

    def __init__(self, runs: dict, fetched: dict, rows: list[pa.RecordBatch]):
        self.runs, self.fetched, self.rows = runs, fetched, rows

    def sources(self) -> Iterator[tuple]:
        """skey, start, n, rank, n_top, n_run, its leaves' digests, its rows."""
        queue = list(self.rows)
        for skey, (start, n, rank, n_top, n_run) in sorted(self.runs.items(), key=lambda x: x[1][2]):
            held, need = [], n_run
            while need:
                batch = queue.pop(0)
                if batch.num_rows > need:
                    queue.insert(0, batch.slice(need))
                    batch = batch.slice(0, need)
                held.append(batch)
                need -= batch.num_rows
            data = b"".join([_hex(b.column("leaf")) for b in held])
            yield skey, start, n, rank, n_top, n_run, data, held


def _hex(column: pa.Array) -> bytes:
    """The digests of a column, one after the other (all are HEX characters long)."""
    return memoryview(column.buffers()[2])[column.offset * HEX:(column.offset + len(column)) * HEX].tobytes() \
        if column.buffers()[1] and column.offset == 0 else "".join(column.to_pylist()).encode()


def _partitions(batches: Iterator[pa.RecordBatch]) -> Iterator[_Partition]:
    pid, runs, fetched, rows = None, {}, {}, []
    for batch in batches:
        pids = batch.column("pid").to_pylist()
        kinds = batch.column("kind").to_pylist()
        start = 0
        while start < len(pids):
            end = start + 1
            while end < len(pids) and pids[end] == pids[start] and kinds[end] == kinds[start]:
                end += 1
            if pids[start] != pid:
                if pid is not None:
                    yield _Partition(runs, fetched, rows)
                pid, runs, fetched, rows = pids[start], {}, {}, []
            part = batch.slice(start, end - start)
            if kinds[start] == 0:
                for skey, *at in zip(*(part.column(c).to_pylist() for c in ("skey", "start", "n", "rank", "n_top", "n_run")),
                                     strict=True):
                    runs[skey] = at
            elif kinds[start] == 1:
                for skey, level, idx, digest in zip(*(part.column(c).to_pylist() for c in ("skey", "level", "idx", "digest")),
                                                    strict=True):
                    fetched.setdefault(skey, {})[level, idx] = digest.encode()
            else:
                rows.append(part.select(["doc_id", "leaf", "forged"]))
            start = end
    if pid is not None:
        yield _Partition(runs, fetched, rows)


def manifest_report(docs: DataFrame) -> DataFrame:
    return manifest(docs).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


# DuckDB: the trees by recursion over levels, CRC-32 bit by bit.
REPORT_SQL = r"""
WITH RECURSIVE
fields AS (
  SELECT doc_id, source, text,
         coalesce(strlen(doc_id::VARCHAR)::VARCHAR || ':' || doc_id::VARCHAR, '-')
         || coalesce(strlen(source)::VARCHAR || ':' || source, '-')
         || coalesce(strlen(lang)::VARCHAR || ':' || lang, '-')
         || coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars::VARCHAR, '-') AS head,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
         xor(list_reduce(list_prepend(4294967295::BIGINT,
               list_transform(range(length(doc_id::VARCHAR)), lambda i: ascii(substr(doc_id::VARCHAR, i + 1, 1))::BIGINT)),
             lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
                                   lambda x, j: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)),
             4294967295::BIGINT) AS crc
  FROM documents),
leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text)::VARCHAR || ':' || text, '-')) AS leaf,
         CASE WHEN crc % 5 = 0 THEN sha256(head || coalesce(strlen(low)::VARCHAR || ':' || low, '-')) END AS forged
  FROM fields),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, leaf) - 1 AS idx,
         dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM leaves),
tree(place, level, idx, digest, n) AS (
  SELECT place, 0, idx, leaf, count(*) OVER (PARTITION BY place) FROM placed
  UNION ALL
  SELECT place, any_value(level) + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(n) + 15) // 16
  FROM tree WHERE n > 1 GROUP BY place, idx // 16),
subroots AS (SELECT place, level, digest FROM tree WHERE n = 1),
top(level, idx, digest, n) AS (
  SELECT 0, place, digest, count(*) OVER () FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(n) + 15) // 16
  FROM top WHERE n > 1 GROUP BY idx // 16),
nodes AS (
  SELECT place, level, idx, digest FROM tree WHERE n > 1
  UNION ALL SELECT -1, level, idx, digest FROM top WHERE n > 1),
steps AS (  -- every leaf's way up: tree, level, index on the way
  SELECT p.doc_id, p.leaf, p.forged, p.place, s.step, s.tree, s.level,
         CASE WHEN s.tree = -1 THEN p.place ELSE p.idx END // (16 ** s.level)::BIGINT AS at
  FROM placed p JOIN (
    SELECT DISTINCT place, place AS tree, level, level AS step FROM tree WHERE n > 1
    UNION ALL
    SELECT r.place, -1, t.level, r.level + t.level FROM subroots r, (SELECT DISTINCT level FROM top WHERE n > 1) t) s
  ON s.place = p.place),
runs AS (
  SELECT s.doc_id, s.leaf, s.place, s.step,
         coalesce(string_agg(n.digest, '' ORDER BY n.idx) FILTER (WHERE n.idx < s.at), '') AS before,
         coalesce(string_agg(n.digest, '' ORDER BY n.idx) FILTER (WHERE n.idx > s.at), '') AS after
  FROM steps s JOIN nodes n ON n.place = s.tree AND n.level = s.level AND n.idx // 16 = s.at // 16
  GROUP BY ALL),
folded(doc_id, leaf, step, digest) AS (
  SELECT doc_id, leaf, 0, coalesce(forged, leaf) FROM placed
  UNION ALL
  SELECT f.doc_id, f.leaf, f.step + 1, sha256(r.before || f.digest || r.after)
  FROM folded f JOIN runs r ON r.doc_id = f.doc_id AND r.leaf = f.leaf AND r.step = f.step),
proofs AS (SELECT doc_id, leaf, sha256(string_agg(before || after, '' ORDER BY step)) AS proof_sha256 FROM runs GROUP BY ALL),
ends AS (SELECT doc_id, leaf, arg_max(digest, step) AS folded_root FROM folded GROUP BY ALL)
SELECT p.doc_id, p.leaf, r.digest AS subroot, t.digest AS root, coalesce(q.proof_sha256, sha256('')) AS proof_sha256,
       e.folded_root, e.folded_root = t.digest AS verified
FROM placed p JOIN subroots r ON r.place = p.place JOIN (SELECT digest FROM top WHERE n = 1) t ON true
JOIN ends e ON e.doc_id = p.doc_id AND e.leaf = p.leaf
LEFT JOIN proofs q ON q.doc_id = p.doc_id AND q.leaf = p.leaf
"""
