"""Language identification by multilingual mixture inference.

Each language is a distribution over hashed byte trigrams, counted over all
labelled training documents. A document is a mixture: expectation maximisation
estimates the proportions of all learned languages from its trigrams' likelihoods. The
set of languages is selected by penalised likelihood: the strongest 1, 2, ...
languages are fitted again by themselves, and the set with the largest log-likelihood
less PENALTY * log(trigrams) for every further language is taken. A document's larger
sets are left out only where a bound shows that none can be better. The prediction is
the language with the largest proportion, the score that proportion.

ASCII letters are lower-cased, other ASCII bytes part words. Documents of a slice
run through the iterations together, but no result depends on the neighbours; whole texts are counted.

Defined edge cases: null text and text without a letter are ``und`` with score 0,
and so is everything if nothing can be learned from; rows without a doc_id, and
rows whose lang is null, are not learned from; ties go to the language first in
code point order; rows that repeat a doc_id are predicted each for itself; an empty
table gives an empty result; further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import slices

BUCKETS = 1 << 15
SMOOTHING = 0.1
STEPS = 12
PENALTY = 3.0  # overlapping trigrams count every byte three times
CELLS = 1 << 22  # trigrams times languages that are worked on at once, unless one document has more
UNKNOWN = "und"
_FOLD = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in range(256))


def trigrams(text: str) -> np.ndarray:
    """The bucket of every byte trigram of the folded text."""
    raw = np.frombuffer(b" " + text.encode().translate(_FOLD).lower() + b" ", np.uint8).astype(np.uint32)
    code = (raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]
    code = code[(raw[1:-1] != 32) | ((raw[:-2] != 32) & (raw[2:] != 32))]  # no runs of blanks
    return ((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - 15)).astype(np.int64)


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


@dataclass
class Languages:
    names: list[str]
    log_p: np.ndarray  # bucket, language


def learn(docs: DataFrame, smoothing: float = SMOOTHING) -> Languages:
    """From text and lang of all given rows; one count per language and bucket
    is all that reaches the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for part in slices(batches):
            for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                if lang not in held:
                    held[lang] = np.zeros(BUCKETS, np.int64)
                held[lang] += np.bincount(trigrams(text), minlength=BUCKETS)
            if len(held) > 64:
                yield from emit(held)
                held = {}
        yield from emit(held)

    def emit(held: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(counts[at])],
                                             ["lang", "bucket", "n"])

    rows = (docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
            .mapInArrow(count, "lang string, bucket long, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    names = sorted(rows["lang"].unique(), key=lambda x: x.encode())
    counts = np.zeros((BUCKETS, len(names)))
    counts[rows["bucket"], rows["lang"].map({n: i for i, n in enumerate(names)})] = rows["n"]
    return Languages(names, np.log((counts + smoothing) / (counts.sum(axis=0) + smoothing * BUCKETS)))


def _climb(p: np.ndarray, n: np.ndarray, doc: np.ndarray, starts: np.ndarray, share: np.ndarray, total: np.ndarray, steps: int):
    """EM steps on all documents at once: the proportions and their log-likelihood."""
    for _ in range(steps):
        joint = p * share[doc]
        joint *= (n / joint.sum(axis=1))[:, None]
        share = np.add.reduceat(joint, starts, axis=0) / total[:, None]
    return share, np.add.reduceat(n * np.log((p * share[doc]).sum(axis=1)), starts)


def mixtures(texts: list[str], model: Languages) -> np.ndarray:
    """Proportions (document, language); zero outside the selected set."""
    grams = []
    for text in texts:
        counts = np.bincount(trigrams(text), minlength=BUCKETS)
        at = np.flatnonzero(counts)
        grams.append((at, counts[at]))
    out = np.zeros((len(texts), len(model.names)))
    part: list[int] = []
    cells = 0
    for i, (at, _) in enumerate(grams):
        if not len(at):
            continue
        if part and cells + len(at) * len(model.names) > CELLS:
            out[part] = _fitted([grams[k] for k in part], model)
            part, cells = [], 0
        part.append(i)
        cells += len(at) * len(model.names)
    if part:
        out[part] = _fitted([grams[k] for k in part], model)
    return out


def _fitted(grams: list[tuple[np.ndarray, np.ndarray]], model: Languages) -> np.ndarray:
    """Proportions of documents that have trigrams."""
    at = np.concatenate([a for a, _ in grams])
    n = np.concatenate([c for _, c in grams]).astype(np.float64)
    sizes = np.array([len(a) for a, _ in grams])
    total = np.add.reduceat(n, np.r_[0, np.cumsum(sizes)[:-1]])
    log_p = model.log_p[at]
    p = np.exp(log_p - log_p.max(axis=1, keepdims=True))
    doc, starts = np.repeat(np.arange(len(sizes)), sizes), np.r_[0, np.cumsum(sizes)[:-1]]
    alone = np.add.reduceat(log_p * n[:, None], starts, axis=0)
    full, _ = _climb(p, n, doc, starts, np.full(alone.shape, 1 / alone.shape[1]), total, STEPS)
    mix = (p * full[doc]).sum(axis=1)
    slope = np.add.reduceat(p * (n / mix)[:, None], starts, axis=0)
    # No mixture of whichever languages has a larger log-likelihood: it is concave in the proportions, and p is at most 1.
    bound = np.minimum(np.add.reduceat(n * np.log(mix), starts) + slope.max(axis=1) - total, 0)
    order = np.lexsort((-alone, -full), axis=1)  # document, place -> language
    p, full = np.take_along_axis(p, order[doc], axis=1), np.take_along_axis(full, order, axis=1)
    best, best_value = np.zeros(alone.shape), np.full(len(sizes), -np.inf)
    cost = PENALTY * np.log(np.maximum(total, 2))
    left = np.arange(len(sizes))  # documents that a larger set may still improve
    for size in range(1, alone.shape[1] + 1):
        start = np.maximum(full[left, :size], 1e-6)
        share, value = _climb(p[:, :size], n, doc, starts, start / start.sum(axis=1, keepdims=True), total[left],
                              1 if size == 1 else STEPS // 2)
        value = value - (size - 1) * cost[left]
        better = value > best_value[left]
        best[left[better], :size] = share[better]
        best_value[left[better]] = value[better]
        more = bound[left] - size * cost[left] > best_value[left]
        if not more.any():
            break
        if not more.all():
            rows = more[doc]
            left, p, n = left[more], p[rows], n[rows]
            doc, starts = np.repeat(np.arange(len(left)), sizes[left]), np.r_[0, np.cumsum(sizes[left])[:-1]]
    out = np.zeros(alone.shape)
    np.put_along_axis(out, order, best, axis=1)
    return out


def predict(docs: DataFrame, model: Languages) -> DataFrame:
    """doc_id, lang_pred, score and the selected languages, the largest first."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("languages", T.ArrayType(T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part in slices(batches):
            texts = part.column(1).to_pylist()
            share = (mixtures([t if has_letter(t) else "" for t in texts], model) if model.names
                     else np.zeros((len(texts), 1)))
            names, scores, sets = [], [], []
            for row in share:
                found = [i for i in np.argsort(-row, kind="stable") if row[i] > 0]
                names.append(model.names[found[0]] if found else UNKNOWN)
                scores.append(min(1.0, float(row[found[0]])) if found else 0.0)
                sets.append([model.names[i] for i in found])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                                              pa.array(sets, pa.list_(pa.string()))], ["doc_id", "lang_pred", "score", "languages"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def language_report(docs: DataFrame) -> DataFrame:
    """Learned from the documents whose crc32 remainder is not 2; all are predicted."""
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = learn(docs.where(remainder != 2).select("text", "lang"))
    return predict(docs, model).select("doc_id", F.coalesce(remainder == 2, F.lit(False)).alias("held_out"),
                                       "lang_pred", "score", "languages")
