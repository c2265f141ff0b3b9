"""Embeddings and nearest-chunk retrieval (V4, V6-V9).

* V4 ``HashingEmbedder``: the built-in default embedder (token hashing to a
  fixed dimension, corpus IDF, L2 normalisation) from Spark ML. Any external
  model plugs in as a ``DataFrame(chunk_id, embedding)``.
* V6 ``vector_topk``: exact cosine top-k of a batch of query vectors against
  the whole chunk table. The query batch goes to the tasks in blocks of
  MAX_QUERY_BYTES, one at a time on the driver; every task multiplies tiles of
  TILE queries with its Arrow batches of chunk vectors in numpy (memory:
  the block, the batch, and TILE x batch rows distances) and keeps only its own
  top-k per query; a final ``row_number() <= k`` per query merges at
  most ``k x tasks`` rows per query. The chunk table is never shuffled.
* V7 ``vector_topk_lsh``: approximate top-k: bands of random-hyperplane signs
  (BITS per band, one bucket key each) equi-joined between queries and
  chunks on ids alone; vectors are fetched for the surviving pairs only, and
  those are ranked by exact distance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import schemas as S
from quarry.functions.paging import top_k_per_group
from quarry.functions.scratch import materialize

# Bound on the query vectors (float64) that travel to the tasks at a time, and
# queries whose distances to an Arrow batch are held at a time.
MAX_QUERY_BYTES = 64 * 1024 * 1024
TILE = 256

TOPK_SCHEMA = T.StructType([
    T.StructField("question_id", T.LongType()),
    T.StructField("chunk_id", T.StringType()),
    T.StructField("distance", T.DoubleType()),
])


def _unit(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    n[n == 0] = 1.0
    return m / n


def _partition_topk(qids, qmat, qcorpus, k):
    """mapInPandas body: running top-k per query over the Arrow batches of one
    task. Only distances that can still enter a query's top-k leave numpy."""
    corpora = np.array([c if c is not None else "" for c in qcorpus], dtype=object)
    filtered = np.array([c is not None for c in qcorpus], dtype=bool)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = [[] for _ in qids]                     # per query: [(distance, chunk_id)]
        worst = np.full(len(qids), np.inf)            # its k-th distance so far
        for b in batches:
            if len(b) == 0:
                continue
            x = _unit(np.stack(b["embedding"].map(lambda v: np.asarray(v, dtype=np.float64)).to_numpy()))
            ids, corp = b["chunk_id"].to_numpy(dtype=object), b["corpus"].to_numpy(dtype=object)
            for t in range(0, len(qids), TILE):
                d = 1.0 - qmat[t:t + TILE] @ x.T      # (queries of the tile, rows) cosine distances
                if filtered[t:t + TILE].any():
                    d[filtered[t:t + TILE, None] & (corpora[t:t + TILE, None] != corp[None, :])] = np.inf
                # every row tied with the k-th distance stays a candidate, so
                # the final (distance, chunk_id) order is exact
                bound = worst[t:t + TILE]
                if d.shape[1] > k:
                    bound = np.minimum(bound, np.partition(d, k - 1, axis=1)[:, k - 1])
                qi, at = np.nonzero((d <= bound[:, None]) & np.isfinite(d))
                for q, j in zip(qi.tolist(), at.tolist()):
                    best[t + q].append((float(d[q, j]), ids[j]))
                for q in set(qi.tolist()):
                    best[t + q] = sorted(best[t + q])[:k]
                    if len(best[t + q]) == k:
                        worst[t + q] = best[t + q][-1][0]
        rows = [(q, c, dist) for q, hits in zip(qids, best) for dist, c in hits]
        yield pd.DataFrame({"question_id": pd.Series([r[0] for r in rows], dtype="int64"),
                            "chunk_id": pd.Series([r[1] for r in rows], dtype=object),
                            "distance": pd.Series([r[2] for r in rows], dtype="float64")})
    return run


def _collect_queries(queries: DataFrame, d: int):
    """One block of the query batch on the driver (its size was checked)."""
    rows = queries.select("question_id", "embedding",
                          (F.col("corpus") if "corpus" in queries.columns
                           else F.lit(None).cast("string")).alias("corpus")).collect()
    qids = [r["question_id"] for r in rows]
    qmat = _unit(np.array([np.asarray(r["embedding"], dtype=np.float64) for r in rows])) if rows \
        else np.zeros((0, d))
    qcorpus = [r["corpus"] for r in rows]
    return qids, qmat, qcorpus


def vector_topk(chunks: DataFrame, queries: DataFrame, k: int = S.DEFAULT_TOP_K,
                corpus_col: str = "metadata.corpus") -> DataFrame:
    """V6 (+V8): the k nearest chunks of each query by cosine distance.

    ``chunks(chunk_id, embedding, metadata)``; ``queries(question_id,
    embedding[, corpus])`` -- a non-null ``corpus`` keeps only chunks with
    that ``metadata.corpus`` before ranking. Returns (question_id, rank,
    chunk_id, distance); ties are broken by chunk_id; distances are clamped
    at 0 and rounded to 6 digits.
    A query batch beyond MAX_QUERY_BYTES is answered block by block; each
    block's result is written to the shared scratch folder before the next block
    is read, so the driver holds one block at a time.
    """
    stats = queries.select(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("d")).first()
    n, d = stats["n"], stats["d"] or 0
    per_block = max(1, MAX_QUERY_BYTES // (max(d, 1) * 8))
    blocks = max(1, math.ceil(n / per_block))
    if blocks == 1:
        return _topk_block(chunks, queries, k, corpus_col, d)
    out = None
    for b in range(blocks):
        part = materialize(_topk_block(chunks, queries.filter(F.pmod(F.xxhash64("question_id"), F.lit(blocks)) == b),
                                       k, corpus_col, d), "topk-block")
        out = part if out is None else out.unionByName(part)
    return out


def _topk_block(chunks, queries, k, corpus_col, d):
    qids, qmat, qcorpus = _collect_queries(queries, d)
    has_filter = any(c is not None for c in qcorpus)
    spark = chunks.sparkSession
    if not qids:
        return spark.createDataFrame([], TOPK_SCHEMA.add("rank", T.IntegerType()))
    c = chunks.select("chunk_id", "embedding", F.col(corpus_col).alias("corpus"))
    if has_filter:
        wanted = sorted({x for x in qcorpus if x is not None})
        if all(x is not None for x in qcorpus):
            c = c.filter(F.col("corpus").isin(wanted))    # pushed to the scan
    part = c.mapInPandas(_partition_topk(qids, qmat, qcorpus, k), TOPK_SCHEMA)
    ranked = top_k_per_group(part, ["question_id"], [F.col("distance"), F.col("chunk_id")], k,
                             rank_col="rank")
    return ranked.select("question_id", F.col("rank").cast("int").alias("rank"), "chunk_id",
                         F.round(F.greatest(F.lit(0.0), F.col("distance")), 6).alias("distance"))


def retrieve(chunks: DataFrame, queries: DataFrame, k: int = S.DEFAULT_TOP_K) -> DataFrame:
    """V9: hits with chunk text and metadata, nearest first."""
    top = vector_topk(chunks, queries, k)
    c = chunks.select("chunk_id", "text", "metadata")
    return c.join(top, "chunk_id").select("question_id", "rank", "chunk_id", "text", "metadata",
                                          "distance")


# ---------------------------------------------------------------------------
# V7: approximate top-k with random-projection LSH
# ---------------------------------------------------------------------------

BITS, BANDS = 8, 96  # nearest vectors at a cosine of 1/3 share a band with chance 0.9, orthogonal ones 0.3


def sign_bands(df: DataFrame, id_col: str, d: int, bits: int, bands: int, seed: int) -> DataFrame:
    """(id, band, key): the signs of ``bits`` random projections per band as an
    integer. A zero vector has all signs positive, as any fixed choice would do."""
    planes = np.random.default_rng(seed).normal(size=(bands * bits, d))
    weights = 1 << np.arange(bits)
    id_field = df.schema[id_col]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b) == 0:
                continue
            x = np.stack(b["embedding"].map(lambda v: np.asarray(v, dtype=np.float64)).to_numpy())
            keys = ((x @ planes.T >= 0).reshape(len(x), bands, bits) * weights).sum(axis=2)
            yield pd.DataFrame({id_col: np.repeat(b[id_col].to_numpy(), bands), "band": np.tile(np.arange(bands), len(x)),
                                "key": keys.ravel()})

    schema = T.StructType([id_field, T.StructField("band", T.IntegerType()), T.StructField("key", T.IntegerType())])
    return df.select(id_col, "embedding").mapInPandas(run, schema)


def lsh_candidates(chunks: DataFrame, queries: DataFrame, bits: int = BITS, bands: int = BANDS, seed: int = 7) -> DataFrame:
    """(question_id, chunk_id) pairs that share a bucket in at least one band; ids only."""
    d = queries.select(F.max(F.size("embedding"))).first()[0] or 1
    ck = sign_bands(chunks, "chunk_id", d, bits, bands, seed)
    qk = sign_bands(queries, "question_id", d, bits, bands, seed)
    return qk.join(ck, ["band", "key"]).select("question_id", "chunk_id").distinct()


def vector_topk_lsh(chunks: DataFrame, queries: DataFrame, k: int = S.DEFAULT_TOP_K,
                    bits: int = BITS, bands: int = BANDS, seed: int = 7) -> DataFrame:
    """V7: top k per query among the candidates, by exact cosine distance (1 to
    a zero vector). More bits per band prune more, more bands find more."""
    norm = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x))
    dot = F.aggregate(F.zip_with("qe", "ce", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda a, x: a + x)
    cand = (lsh_candidates(chunks, queries, bits, bands, seed)
            .join(queries.select("question_id", F.col("embedding").alias("qe")), "question_id")
            .join(chunks.select("chunk_id", F.col("embedding").alias("ce")), "chunk_id"))
    lengths = norm("qe") * norm("ce")
    scored = cand.select("question_id", "chunk_id",
                         F.when(lengths == 0, F.lit(1.0)).otherwise(F.lit(1.0) - F.try_divide(dot, lengths)).alias("distance"))
    ranked = top_k_per_group(scored, ["question_id"], [F.col("distance"), F.col("chunk_id")], k,
                             rank_col="rank")
    return ranked.select("question_id", F.col("rank").cast("int").alias("rank"), "chunk_id",
                         F.round(F.greatest(F.lit(0.0), F.col("distance")), 6).alias("distance"))


# ---------------------------------------------------------------------------
# V4: default embedder
# ---------------------------------------------------------------------------

class HashingEmbedder:
    """Token hashing (``HashingTF``) + corpus ``IDF`` + L2 ``Normalizer``,
    returned as a dense ``array<float>``. ``fit`` runs one distributed pass
    over the chunk texts (document frequencies)."""

    def __init__(self, num_features: int = 1024):
        self.num_features = num_features
        self.model = None

    def _tf(self, df, text_col):
        from pyspark.ml.feature import HashingTF
        from quarry.operators.search import fts_tokens
        tok = df.withColumn("_tok", fts_tokens(F.col(text_col)))
        return HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=self.num_features).transform(tok)

    def fit(self, chunks: DataFrame, text_col: str = "text") -> "HashingEmbedder":
        from pyspark.ml.feature import IDF
        self.model = IDF(inputCol="_tf", outputCol="_tfidf").fit(self._tf(chunks, text_col))
        return self

    def _finish(self, tf: DataFrame, out_col: str) -> DataFrame:
        from pyspark.ml.feature import Normalizer
        from pyspark.ml.functions import vector_to_array
        x = Normalizer(inputCol="_tfidf", outputCol="_n", p=2.0).transform(self.model.transform(tf))
        return x.withColumn(out_col, vector_to_array("_n", "float32")).drop("_tok", "_tf", "_tfidf", "_n")

    def transform(self, df: DataFrame, text_col: str = "text", out_col: str = "embedding") -> DataFrame:
        return self._finish(self._tf(df, text_col), out_col)

    def fit_transform(self, chunks: DataFrame, text_col: str = "text",
                      out_col: str = "embedding") -> DataFrame:
        """Fit and embed with one pass over the text: term frequencies are
        written once to the shared scratch folder, then IDF is fitted on and
        applied to them."""
        from pyspark.ml.feature import IDF
        tf = materialize(self._tf(chunks, text_col).drop("_tok"), "term-frequencies")
        self.model = IDF(inputCol="_tf", outputCol="_tfidf").fit(tf)
        return self._finish(tf, out_col)
