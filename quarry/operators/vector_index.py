"""V7 as a written index: chunks stored by cell, a search reads the cells next to its questions.

``build_index`` fits the cells' centres by k-means on unit vectors (Lloyd steps in Spark, partial sums per
task; the sample is bounded: ``SAMPLE_PER_CELL`` vectors a cell), then stores every chunk under the
cell of its nearest centre. ``append_chunks`` stores later chunks under the same cells, as a segment
with a commit record (see ``page_index``): a killed attempt is not seen and a repeated one adds
nothing. ``search`` ranks the centres for every question and reads the nearest ``probes`` cells only: the
others' folders are pruned, and a question meets the rows of its own cells alone. Distances
are exact.

How many cells must be read for a wanted recall depends on the vectors: few if they form clusters, many if
neighbours are hardly nearer than other vectors. So the number is measured when the index is built:
for ``CALIBRATION`` questions or stored vectors the exact neighbours are found, and ``probes`` is the least
number of nearest cells that holds the wanted share of them.

Null, empty, zero or non-finite embeddings have no direction: such chunks are not stored, and such questions find nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import schemas as S
from quarry.functions.paging import top_k_per_group
from quarry.functions.scratch import materialize
from quarry.operators.page_index import _commit, commits, live_segments
from quarry.operators.vectors import MAX_QUERY_BYTES, TOPK_SCHEMA, _collect_queries

CENTRE_BYTES = 32 << 20  # bound on all centres (float64)
SAMPLE_PER_CELL = 256
STEPS = 6
CALIBRATION = 64
ROWS = 512  # vectors that meet all centres at once


@dataclass
class VectorIndex:
    path: str
    centres: np.ndarray  # cells x dimensions, unit length
    probes: int
    vectors: DataFrame  # the stored chunks with their cell


def _directed(df: DataFrame) -> DataFrame:
    """The rows whose embedding has a direction."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    return df.where(F.coalesce(fine, F.lit(False)))


def _units(column: pa.Array, d: int) -> np.ndarray:
    if not len(column):
        return np.empty((0, d))
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([np.argmax(x[i:i + ROWS] @ centres.T, axis=1) for i in range(0, len(x), ROWS)] or [np.empty(0, np.int64)])


def _lloyd(sample: DataFrame, centres: np.ndarray) -> np.ndarray:
    """One step: every cell's centre moves to the mean direction of its vectors."""
    d = centres.shape[1]
    sent = sample.sparkSession.sparkContext.broadcast(centres)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros_like(sent.value)
        for batch in batches:
            if batch.num_rows:
                x = _units(batch.column(0), d)
                np.add.at(total, _nearest(x, sent.value), x)
        used = np.flatnonzero(np.abs(total).sum(axis=1) > 0)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([r.tobytes() for r in total[used]], pa.binary())], ["cell", "total"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for cell, total in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held[cell] = held.get(cell, 0) + np.frombuffer(total)
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([t.tobytes() for t in held.values()], pa.binary())],
                                         ["cell", "total"])

    kind = "cell int, total binary"
    rows = sample.mapInArrow(partial, kind).repartition("cell").mapInArrow(summed, kind)
    out = centres.copy()
    for row in rows.collect():  # a row per cell, CENTRE_BYTES at most
        total = np.frombuffer(bytes(row.total))
        length = np.linalg.norm(total)
        if length > 0:
            out[row.cell] = total / length
    return out


def fit_centres(chunks: DataFrame, cells: int | None = None) -> np.ndarray:
    """Centres from a sample of at most about SAMPLE_PER_CELL vectors a cell, chosen by the hash of their
    ids; ``cells`` defaults to four times the root of the number of vectors."""
    vectors = _directed(chunks)
    n, d = vectors.agg(F.count("*"), F.max(F.size("embedding"))).first()
    if not n:
        return np.zeros((0, 0))
    cells = min(cells or round(4 * math.sqrt(n)), n, max(1, CENTRE_BYTES // (8 * d)))
    share = min(1.0, cells * SAMPLE_PER_CELL / n)
    draw = F.pmod(F.xxhash64("chunk_id"), F.lit(1 << 30))
    sample = materialize(vectors.where(draw < F.lit(int(share * (1 << 30)) + 1)).select("embedding", F.xxhash64("chunk_id").alias("h")), "cell-sample")
    first = sample.orderBy("h").limit(cells).select("embedding").collect()
    centres = np.array([r.embedding for r in first], np.float64)
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    for _ in range(STEPS):
        centres = _lloyd(sample.select("embedding"), centres)
    return centres


def with_cells(chunks: DataFrame, centres: np.ndarray) -> DataFrame:
    """The chunks that have a direction, with the cell of their nearest centre: a narrow pass."""
    sent = chunks.sparkSession.sparkContext.broadcast(centres)
    names = [c for c in chunks.columns if c != "cell"]
    schema = T.StructType([*[chunks.schema[c] for c in names], T.StructField("cell", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _units(batch.column("embedding"), sent.value.shape[1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_nearest(x, sent.value), pa.int32())], [*names, "cell"])

    return _directed(chunks.select(*names)).mapInArrow(run, schema)


def append_chunks(chunks: DataFrame, path: str, segment: str) -> bool:
    """Store ``chunks`` under the cells of the index; False if the segment is committed already."""
    spark = chunks.sparkSession
    if segment in commits(spark, path):
        return False
    centres = _centres(spark, path)[0]
    if not len(centres):
        raise ValueError("the index was built without a vector: build it anew")
    return _store(chunks, path, segment, centres)


def _store(chunks: DataFrame, path: str, segment: str, centres: np.ndarray) -> bool:
    spark = chunks.sparkSession
    folder = f"{path}/vectors/segment={segment}"
    # a cell with many of all vectors is split over several writers
    with_cells(chunks, centres).hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(folder)
    stored = _directed(chunks).count()
    _commit(spark, path, segment, stored, len(centres), [])
    return True


def _centres(spark: SparkSession, path: str) -> tuple[np.ndarray, int]:
    rows = spark.read.parquet(f"{path}/centres").orderBy("cell").collect()
    return (np.array([r.centre for r in rows], np.float64), rows[0].probes) if rows else (np.zeros((0, 0)), 0)


def build_index(chunks: DataFrame, path: str, cells: int | None = None, recall: float = 0.95, k: int = S.DEFAULT_TOP_K,
                questions: DataFrame | None = None) -> VectorIndex:
    """Fit the cells on ``chunks(chunk_id, embedding, ...)``, store all of them, and measure how many cells a
    search must read, on ``questions(question_id, embedding)`` if their kind differs from the chunks' (CALIBRATION of
    them count), else on stored vectors. Call it on an empty folder."""
    spark = chunks.sparkSession
    centres = fit_centres(chunks, cells)
    _store(chunks, path, "built", centres)
    probes = _calibrated(_opened(spark, path, centres, len(centres)), questions, recall, k) if len(centres) else 0
    (spark.createDataFrame([(i, c.tolist(), probes) for i, c in enumerate(centres)], "cell int, centre array<double>, probes int")
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/centres"))
    return _opened(spark, path, centres, probes)


def _opened(spark: SparkSession, path: str, centres: np.ndarray, probes: int) -> VectorIndex:
    known = commits(spark, path)
    segments = [s for s in live_segments(spark, path) if known[s].pages]
    if not segments:
        vectors = spark.createDataFrame([], "chunk_id string, embedding array<float>, cell int")
    else:
        vectors = (spark.read.option("basePath", f"{path}/vectors")
                   .parquet(*[f"{path}/vectors/segment={s}" for s in segments]).drop("segment"))
    return VectorIndex(path, centres, probes, vectors)


def open_index(spark: SparkSession, path: str) -> VectorIndex:
    """All committed segments of the index under ``path``."""
    return _opened(spark, path, *_centres(spark, path))


def _calibrated(index: VectorIndex, questions: DataFrame | None, recall: float, k: int) -> int:
    """The least number of nearest cells that holds the wanted share of the questions' exact neighbours."""
    if questions is None:  # a stored vector is its own nearest neighbour, which does not count
        questions = index.vectors.orderBy(F.xxhash64("chunk_id"), "chunk_id").limit(CALIBRATION).select(
            F.row_number().over(_by_hash()).cast("long").alias("question_id"), "embedding", F.col("chunk_id").alias("own"))
    else:
        questions = (questions.select("question_id", "embedding", F.lit(None).cast("string").alias("own"))
                     .orderBy(F.xxhash64("question_id"), "question_id").limit(CALIBRATION))
    questions = materialize(questions, "cell-calibration")
    near = search(index, questions.drop("own"), k + 1, probes=len(index.centres))
    found = (near.join(questions, "question_id").where((F.col("own").isNull() & (F.col("rank") <= k)) | (F.col("chunk_id") != F.col("own")))
             .join(index.vectors.select("chunk_id", "cell"), "chunk_id").select("embedding", "cell").collect())  # CALIBRATION * k rows or so
    if not found:
        return len(index.centres)
    x = np.array([r.embedding for r in found], np.float64)
    alike = x / np.linalg.norm(x, axis=1, keepdims=True) @ index.centres.T
    own = alike[np.arange(len(found)), [r.cell for r in found]]
    rank = (alike > own[:, None]).sum(axis=1) + 1
    return int(np.sort(rank)[max(0, math.ceil(recall * len(rank)) - 1)])


def _by_hash():
    from pyspark.sql.window import Window

    return Window.orderBy(F.xxhash64("chunk_id"), "chunk_id")  # over CALIBRATION rows


def _probed_topk(qids, qmat, qcorpus, k: int, of_cell: dict[int, np.ndarray], d: int):
    """mapInArrow body: the running top k of each question over the rows of its cells, ties with the k-th kept."""
    corpora = np.array([c if c is not None else "" for c in qcorpus], dtype=object)
    filtered = np.array([c is not None for c in qcorpus], dtype=bool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in qids]
        worst = np.full(len(qids), np.inf)
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            ids, held = batch.column("chunk_id").to_pylist(), np.array(batch.column("corpus").to_pylist(), dtype=object)
            x = _units(batch.column("embedding"), d) if batch.num_rows else None
            for a, b in pairwise(np.r_[0, np.flatnonzero(cells[1:] != cells[:-1]) + 1, len(cells)].tolist() if len(cells) else []):
                asked = of_cell.get(int(cells[a]))
                if asked is None:
                    continue
                for start in range(a, b, ROWS):
                    rows = slice(start, min(b, start + ROWS))
                    away = 1.0 - qmat[asked] @ x[rows].T
                    if filtered[asked].any():
                        away[filtered[asked][:, None] & (corpora[asked][:, None] != held[None, rows])] = np.inf
                    bound = worst[asked]
                    if away.shape[1] > k:
                        bound = np.minimum(bound, np.partition(away, k - 1, axis=1)[:, k - 1])
                    at_q, at_row = np.nonzero((away <= bound[:, None]) & np.isfinite(away))
                    for q, j in zip(at_q.tolist(), at_row.tolist(), strict=True):
                        best[asked[q]].append((float(away[q, j]), ids[start + j]))
                    for q in set(asked[at_q].tolist()):
                        best[q] = sorted(best[q])[:k]
                        if len(best[q]) == k:
                            worst[q] = best[q][-1][0]
        rows_out = [(q, c, away) for q, hits in zip(qids, best, strict=True) for away, c in hits]
        columns = list(zip(*rows_out, strict=True)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.float64()), strict=True)],
                                         ["question_id", "chunk_id", "distance"])

    return run


def probed_cells(index: VectorIndex, qmat: np.ndarray, probes: int) -> np.ndarray:
    """questions x probes: the nearest cells of each question."""
    alike = qmat @ index.centres.T
    return np.argsort(-alike, axis=1, kind="stable")[:, :probes]


def read_cells(index: VectorIndex, cells) -> DataFrame:
    """The stored rows of some cells; the other cells' folders are not read."""
    return index.vectors.where(F.col("cell").isin([int(c) for c in cells]))


def search(index: VectorIndex, queries: DataFrame, k: int = S.DEFAULT_TOP_K, probes: int | None = None,
           corpus_col: str = "metadata.corpus") -> DataFrame:
    """The k nearest stored chunks of ``queries(question_id, embedding[, corpus])`` among the ``probes`` cells next to
    each (default: as many as the index measured): question_id, rank, chunk_id, distance. Questions are
    answered in blocks of MAX_QUERY_BYTES, each block's result stored before the next one is read."""
    d, probes = index.centres.shape[1], min(probes or index.probes, len(index.centres))
    queries = _directed(queries)
    n = queries.count() if d else 0
    blocks = max(1, math.ceil(n * d * 8 / MAX_QUERY_BYTES))
    has_corpus = corpus_col.split(".")[0] in index.vectors.columns
    out = index.vectors.sparkSession.createDataFrame([], TOPK_SCHEMA)
    for block in range(blocks if n else 0):
        part = queries if blocks == 1 else queries.where(F.pmod(F.xxhash64("question_id"), F.lit(blocks)) == block)
        qids, qmat, qcorpus = _collect_queries(part, d)
        near = probed_cells(index, qmat, probes)
        flat = pd.Series(np.repeat(np.arange(len(qids)), near.shape[1])).groupby(near.ravel())
        of_cell = {int(c): np.sort(q.to_numpy()) for c, q in flat}
        corpus = F.col(corpus_col) if has_corpus else F.lit(None).cast("string")
        rows = read_cells(index, of_cell).select("chunk_id", "embedding", "cell", corpus.alias("corpus"))
        found = rows.mapInArrow(_probed_topk(qids, qmat, qcorpus, k, of_cell, d), TOPK_SCHEMA)
        out = out.unionByName(found if blocks == 1 else materialize(found, "probed"))
    ranked = top_k_per_group(out, ["question_id"], [F.col("distance"), F.col("chunk_id")], k, rank_col="rank")
    return ranked.select("question_id", F.col("rank").cast("int").alias("rank"), "chunk_id",
                         F.round(F.greatest(F.lit(0.0), F.col("distance")), 6).alias("distance"))
