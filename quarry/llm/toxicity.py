"""Toxicity by a classifier chain of linear models.

Categories are predicted one after the other. Each category's model is a
logistic regression on word presence plus the log-odds that the models before it
give. While training, those log-odds come from models of the same kind
fitted without the row's own fold, so that a later model sees the earlier ones
as uncertain as they are on new documents.

A document is rejected from a probability of REJECT, or from the lowest one that rejects, with
95 % confidence, no more than CLEAN_REJECTED of the clean documents, judged by the labelled
ones, each by the models without its fold. One rule for every number of labels.

The chain is fitted on at most SAMPLE labelled documents (the ones whose id hashes
lowest, the same at every run). Spark counts their words; the driver gets the
CANDIDATES words whose documents differ most from the mean, and the sample's
documents as sets of these. Scoring is one narrow pass over all documents and whole
texts.

Defined edge cases: null, empty or white-space text has no words and gets the
chain's prior; a label that is null is not learned from, several labels of a
document are averaged (half counts as 1); documents with equal words are learned
from once; without labels every probability is 0 and nothing is rejected; rows that
repeat a doc_id are scored each for itself; an empty table gives an empty
result; further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import cut, release, slices
from quarry.functions.wordhash import LETTERS_DIGITS, words

SAMPLE = 20_000  # labelled documents that the chain is fitted on
FEATURES = 4096  # words of a model
CANDIDATES = 4 * FEATURES  # words of the sample that models choose from
FOLDS = 5
LEAST_DOCS, LEAST_Z = 4, 4.0  # of a word that a model may use
RIDGE, STEPS = 0.1, 300
REJECT = 0.4  # toxic probability from which a document is rejected, or a lower one (see CLEAN_REJECTED)
CLEAN_REJECTED = 0.0075  # bound on the share of clean documents that a lower threshold rejects
CATEGORIES = ("low_quality", "toxic")  # in the order of the chain


def words_of(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted hashes of the distinct words of each text: ASCII letters and digits, lower-cased, and bytes above."""
    found = words(column, LETTERS_DIGITS)
    for a, b in pairwise(found.texts.tolist()):
        yield np.unique(found.hashes[a:b])


@dataclass
class Linear:
    """Weights by word hash, for the earlier log-odds, and the intercept."""
    words: dict[int, float]
    earlier: np.ndarray
    intercept: float

    def log_odds(self, hashes, earlier: Sequence[float]) -> float:
        return self.intercept + float(np.dot(self.earlier, earlier)) + sum(self.words.get(h, 0.0) for h in hashes)


@dataclass
class Chain:
    categories: tuple[str, ...]
    models: list[Linear | None]
    reject: float = REJECT

    def vocabulary(self) -> np.ndarray:
        """The words that any model knows, sorted."""
        return np.unique(np.array([h for m in self.models if m for h in m.words], np.uint64))

    def probabilities(self, hashes) -> list[float]:
        known = {h for h in hashes if any(m and h in m.words for m in self.models)}
        odds: list[float] = []
        for model in self.models:
            odds.append(_bounded(model.log_odds(known, odds)) if model else 0.0)
        return [float(_sigmoid(x)) if m else 0.0 for x, m in zip(odds, self.models, strict=True)]


def _bounded(x):
    """Log-odds as later models are given them."""
    return np.clip(x, -10.0, 10.0)


def _sigmoid(x):
    return np.where(x >= 0, 1 / (1 + np.exp(-np.abs(x))), np.exp(-np.abs(x)) / (1 + np.exp(-np.abs(x))))


def _fit(row: np.ndarray, word: np.ndarray, dense: np.ndarray, y: np.ndarray, vocabulary: np.ndarray) -> Linear:
    """Ridge logistic regression of y on word presence (row, word pairs) and dense columns.

    Words are chosen by how far their documents' share of ones is from the mean.
    Accelerated descent with a separable curvature bound for the step sizes."""
    n, p = len(y), float(np.clip(y.mean(), 1e-6, 1 - 1e-6))
    docs = np.bincount(word, minlength=len(vocabulary))
    ones = np.bincount(word, y[row], len(vocabulary))
    z = np.abs(ones - docs * p) / np.sqrt(np.maximum(docs, 1) * p * (1 - p))
    z[(docs < LEAST_DOCS) | (docs == n)] = 0
    chosen = np.argsort(-z, kind="stable")[:FEATURES]
    chosen = chosen[z[chosen] >= LEAST_Z]
    column = np.full(len(vocabulary), -1)
    column[chosen] = np.arange(len(chosen))
    use = column[word] >= 0
    row, col, m, k = row[use], column[word[use]], len(chosen), dense.shape[1]
    weight = np.abs(dense).sum(axis=1) + np.bincount(row, minlength=n) + 1
    curve = np.r_[np.bincount(col, weight[row], m), np.abs(dense).T @ weight, weight.sum()] / 4 + RIDGE
    theta = np.r_[np.zeros(m + k), np.log(p / (1 - p))]
    ahead, t = theta.copy(), 1.0
    for _ in range(STEPS):
        score = np.bincount(row, ahead[col], n) + dense @ ahead[m:m + k] + ahead[-1]
        off = _sigmoid(score) - y
        slope = np.r_[np.bincount(col, off[row], m) + RIDGE * ahead[:m], dense.T @ off + RIDGE * ahead[m:m + k], off.sum()]
        new, t_new = ahead - slope / curve, (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, theta, t = new + (t - 1) / t_new * (new - theta), new, t_new
    return Linear(dict(zip(vocabulary[chosen].tolist(), theta[:m].tolist(), strict=True)), theta[m:m + k], float(theta[-1]))


def _scores(model: Linear, row, word, dense, vocabulary) -> np.ndarray:
    weights = np.zeros(len(vocabulary))
    weights[np.searchsorted(vocabulary, np.array(list(model.words), np.uint64))] = list(model.words.values())
    return np.bincount(row, weights[word], len(dense)) + dense @ model.earlier + model.intercept


def _fold_of(words: np.ndarray) -> int:
    return int(np.bitwise_xor.reduce(words)) % FOLDS if len(words) else 0


def _threshold(clean: np.ndarray) -> float:
    """From the out-of-fold probabilities of the clean documents: the lowest that is, with 95 %
    confidence, reached by a share of CLEAN_REJECTED of them at most, and REJECT at most. The
    fewer documents, the wider the bound (Wilson's), so that few of them leave REJECT in force."""
    n, z = max(1, len(clean)), 1.645
    share = np.arange(len(clean)) / n  # if so many of the highest were rejected
    bound = (share + z * z / (2 * n) + z * np.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    allowed = np.flatnonzero(bound <= CLEAN_REJECTED)
    return min(REJECT, float(np.nextafter(np.sort(clean)[::-1][allowed[-1]], 1))) if len(allowed) else REJECT


def fit_chain(words: list[np.ndarray], labels: np.ndarray, categories: Sequence[str], fold: np.ndarray | None = None) -> Chain:
    """From distinct word hashes of each document, its labels (NaN: unknown) and its fold."""
    if fold is None:
        fold = np.array([_fold_of(w) for w in words])
    vocabulary, word = np.unique(np.concatenate([*words, np.empty(0, np.uint64)]), return_inverse=True)
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    dense, models, reject = np.empty((len(words), 0)), [], REJECT
    for c in range(len(categories)):
        y = labels[:, c]
        known = ~np.isnan(y)

        def fit(use: np.ndarray, y: np.ndarray = y, dense: np.ndarray = dense) -> Linear | None:
            if not use.any() or len(np.unique(y[use])) < 2:
                return None
            place = np.cumsum(use) - 1
            mine = use[row]
            return _fit(place[row[mine]], word[mine], dense[use], y[use], vocabulary)

        model, out = fit(known), np.zeros(len(words))
        for k in range(FOLDS) if model else ():
            part = fit(known & (fold != k)) or model
            out[fold == k] = _scores(part, row, word, dense, vocabulary)[fold == k]
        models.append(model)
        dense = np.column_stack([dense, _bounded(out)])
        if model and c == len(categories) - 1:
            reject = _threshold(_sigmoid(dense[known & (y == 0), c]))
    return Chain(tuple(categories), models, reject)


def train(docs: DataFrame, labels: DataFrame, categories: Sequence[str] = CATEGORIES, sample: int = SAMPLE) -> Chain:
    """``labels``: doc_id and a 0/1 column for each category."""
    known = (labels.where("doc_id IS NOT NULL").groupBy("doc_id")
             .agg(*[(F.avg(c) >= 0.5).cast("double").alias(c) for c in categories])
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [w.view(np.int64) for w in words_of(part.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int64())), *[part.column(c) for c in categories]],
                                             ["words", *categories])

    numbers = ", ".join(f"`{c}` double" for c in categories)
    # ``known`` has at most ``sample`` rows of an id and a few numbers
    rows = cut(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", *categories)
               .mapInArrow(hashed, f"words array<long>, {numbers}")
               .groupBy("words").agg(*[(F.avg(c) >= 0.5).cast("double").alias(c) for c in categories]), "toxicity-sample")
    means = rows.agg(*[F.avg(c).alias(c) for c in categories]).first()

    def distance(c: str) -> Column:
        """How far the share of ones among a word's documents is from the mean, in standard errors."""
        p = min(max(means[c] or 0.0, 1e-6), 1 - 1e-6)
        return F.coalesce(F.abs(F.sum(c) - p * F.count(c)) / F.sqrt(F.greatest(F.count(c), F.lit(1)) * (p * (1 - p))), F.lit(0.0))

    far = F.greatest(*[distance(c) for c in categories], F.lit(0.0))
    chosen = (rows.select(F.explode("words").alias("word"), *categories).groupBy("word").agg(F.count("*").alias("docs"), far.alias("far"))
              .where((F.col("docs") >= LEAST_DOCS) & (F.col("far") >= LEAST_Z - 1)).orderBy(F.desc("far"), "word").limit(CANDIDATES))
    candidates = np.sort(np.array([r.word for r in chosen.select("word").collect()], np.int64))

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            found = [np.array(w, np.int64) for w in part.column("words").to_pylist()]
            folds = [_fold_of(w.view(np.uint64)) for w in found]
            kept = [w[np.isin(w, candidates)].tobytes() for w in found]
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.binary()), pa.array(folds, pa.int64()), *[part.column(c) for c in categories]],
                                             ["words", "fold", *categories])

    local = rows.mapInArrow(reduced, f"words binary, fold long, {numbers}").toPandas()
    local = local.sort_values(["words", "fold", *categories], kind="stable")
    values = local[list(categories)].to_numpy(np.float64, na_value=np.nan) if len(local) else np.empty((0, len(categories)))
    chain = fit_chain([np.frombuffer(w, np.uint64) for w in local["words"]], values, categories, local["fold"].to_numpy(np.int64))
    del local, values
    release(docs.sparkSession)
    return chain


def _among(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Those that are known (sorted)."""
    if not len(known):
        return hashes[:0]
    return hashes[known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes]


def _scored(batches: Iterator[pa.RecordBatch], chain: Chain) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    known = chain.vocabulary()
    for part in slices(batches):
        rows = [chain.probabilities(_among(w, known).tolist()) for w in words_of(part.column("text"))]
        yield part, np.array(rows, np.float64).reshape(part.num_rows, len(chain.categories))


def predict(docs: DataFrame, chain: Chain, reject: float | None = None) -> DataFrame:
    """doc_id, one probability per category, rejected (by the last category, from the chain's threshold if none is given)."""
    limit = chain.reject if reject is None else reject
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(c, T.DoubleType()) for c in chain.categories],
                           T.StructField("rejected", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, scores in _scored(batches, shared.value):
            yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c) for c in scores.T], pa.array(scores[:, -1] >= limit)],
                                             ["doc_id", *shared.value.categories, "rejected"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def keep_clean(docs: DataFrame, chain: Chain, reject: float | None = None) -> DataFrame:
    """The rows of ``docs`` that are not rejected, in one narrow pass."""
    limit = chain.reject if reject is None else reject
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, scores in _scored(batches, shared.value):
            yield part.filter(pa.array(scores[:, -1] < limit))

    return docs.mapInArrow(run, docs.schema)


def category_labels(labels: DataFrame) -> DataFrame:
    """The chain's categories from a table of doc_id, quality, toxic."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), F.col("toxic"))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return predict(docs, train(docs, category_labels(labels)))
