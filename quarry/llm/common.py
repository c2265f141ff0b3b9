"""Helpers shared by the corpus operators: tables, scratch tables, words."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
import uuid
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import checkpoint_dir

T = TypeVar("T")

# ASCII white space and the words between it, as Java regular expressions.
WORD = r"[^\x20\x09-\x0D]+"
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def per_process(name: str, make: Callable[[], T]) -> T:
    """A value that is made once in each worker process and serves all its tasks.
    The package's functions travel to the workers by value, so a module variable
    would start anew with every task."""
    held = sys.__dict__.setdefault("_quarry_per_process", {})
    if name not in held:
        held[name] = make()
    return held[name]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """Folder for this application's intermediate tables, inside the shared
    folder named by ``spark.checkpoint.dir``."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/quarry-llm-{spark.sparkContext.applicationId}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts the
    lineage, survives lost executors, computes the rows once."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application. Call it once the
    results that were derived from them have been written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Give back what earlier steps left behind: the driver's Python and Arrow memory, and in its JVM the plans,
    broadcasts and shuffles that nothing refers to any more (Spark drops their files on the executors
    once a collection finds them). Called where an operator with many jobs begins."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)
    spark._jvm.System.gc()


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Smaller zero-copy pieces, so that few texts are Python objects at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def row_key(name: str):
    """A non-null string key of a nullable column: values sort by code point,
    null sorts last and stays apart from every value, the empty one included."""
    c = F.col(name).cast("string")
    return F.when(c.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), c))


def groups(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[dict]:
    """Runs of rows with an equal key, as lists by column; a run may span batches."""
    held: dict | None = None
    last = None
    for batch in batches:
        columns = {n: batch.column(n).to_pylist() for n in batch.schema.names}
        keys = list(zip(*(columns[n] for n in key), strict=True))
        start = 0
        while start < len(keys):
            end = start + 1
            while end < len(keys) and keys[end] == keys[start]:
                end += 1
            piece = {n: c[start:end] for n, c in columns.items()}
            if held is not None and keys[start] == last:
                for n, c in piece.items():
                    held[n] += c
            else:
                if held is not None:
                    yield held
                held, last = piece, keys[start]
            start = end
    if held is not None:
        yield held
