"""Embeddings by any model (V4): the seam between texts and a model that runs in Python.

The model is made by a function, once per worker process (loading it is the costly part). Texts reach it in
batches of similar length, bounded in rows and in characters of the padded batch, so that
memory does not depend on how Spark cut the table. A batch that fails is tried row by row; rows that fail
alone are kept, without an embedding and with the error's text, so one bad text costs neither
the task nor its neighbours.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quarry.functions.workers import per_worker

Model = Callable[[list[str]], Sequence]
ROWS_AT_ONCE = 1024  # rows among which batches of similar length are formed


def length_batches(lengths: Sequence[int], max_rows: int, max_chars: int) -> Iterator[list[int]]:
    """Row numbers in batches of similar length: at most ``max_rows`` rows, and at most ``max_chars`` characters if
    all were as long as the longest; a longer text is a batch of its own."""
    batch: list[int] = []
    for i in sorted(range(len(lengths)), key=lambda i: (lengths[i], i)):
        if batch and (len(batch) == max_rows or (len(batch) + 1) * lengths[i] > max_chars):
            yield batch
            batch = []
        batch.append(i)
    if batch:
        yield batch


def _run(model: Model, texts: list[str]) -> list[tuple[object, str | None]]:
    """(embedding, error) of each text."""
    try:
        found = list(model(texts))
        if len(found) != len(texts):
            raise ValueError(f"the model gave {len(found)} embeddings for {len(texts)} texts")
        out = [np.asarray(v, np.float32) for v in found]
        if any(v.ndim != 1 for v in out):
            raise ValueError("an embedding must be a vector")
        return [(v, None) for v in out]
    except Exception as e:  # whatever a model raises belongs to its rows
        if len(texts) == 1:
            return [(None, f"{type(e).__name__}: {e}")]
        return [r for t in texts for r in _run(model, [t])]


def embed_with(df: DataFrame, make_model: Callable[[], Model], name: str, text_col: str = "text", out_col: str = "embedding",
               error_col: str = "error", max_rows: int = 64, max_chars: int = 1 << 18) -> DataFrame:
    """``df`` with the model's embedding (array<float>, null if there is none) and the error (null if none). ``name``
    stands for the model in the worker's memory: two models need two names. A null text has neither;
    an empty one goes to the model. Columns of these two names are replaced; a narrow pass."""
    kept = [f for f in df.schema.fields if f.name not in (out_col, error_col)]
    schema = T.StructType([*kept, T.StructField(out_col, T.ArrayType(T.FloatType())), T.StructField(error_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                texts = part.column(text_col).to_pylist()
                rows = [i for i, t in enumerate(texts) if t is not None]
                found: list[tuple] = [(None, None)] * len(texts)
                for chosen in length_batches([len(texts[i]) for i in rows], max_rows, max_chars):
                    model = model or per_worker(f"model {name}", make_model)
                    at = [rows[i] for i in chosen]
                    for i, r in zip(at, _run(model, [texts[i] for i in at]), strict=True):
                        found[i] = r
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), pa.array([v for v, _ in found], pa.list_(pa.float32())),
                                                  pa.array([e for _, e in found], pa.string())], schema.names)

    return df.select(*[f.name for f in kept]).mapInArrow(run, schema)
