"""Overlapping word-window chunks of page text.

All array work (split, slice, join) is built-in and runs inside the page's
row: no shuffle, no UDF.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.functions.text import py_strip, py_words


def chunk_text(pages: DataFrame, size: int = S.CHUNK_WORDS, overlap: int = S.CHUNK_OVERLAP) -> DataFrame:
    """V1+V2: windows of ``size`` words every ``size-overlap`` words, joined by
    one space; ``ceil(n/step)`` chunks per page (a tail chunk may repeat words
    already covered). Empty pages yield no chunk. chunk_id =
    ``<doc_id>_<page_num>_<idx>``. Extra columns of ``pages`` are kept."""
    step = size - overlap
    t = py_strip(F.coalesce(F.col("text"), F.lit("")))
    # the word array is its own column: Catalyst does not share a common
    # subexpression with a lambda body, so inlining it would split per chunk
    p = pages.withColumn("text", t).filter(F.length("text") > 0) \
        .withColumn("_words", py_words(F.col("text")))
    words = F.col("_words")
    n = F.size(words)
    starts = F.sequence(F.lit(0), (F.ceil(n / F.lit(float(step))) - 1).cast("int"))
    chunks = F.transform(starts, lambda i: F.array_join(F.slice(words, i * step + 1, size), " "))
    out = p.select(*[c for c in p.columns if c not in ("text", "_words")],
                   F.posexplode(chunks).alias("chunk_idx", "text"))
    out = out.filter(F.length(F.trim("text")) > 0)
    return out.withColumn("chunk_id", F.concat_ws("_", "doc_id", F.col("page_num").cast("string"),
                                                  F.col("chunk_idx").cast("string")))


def with_metadata(chunks: DataFrame) -> DataFrame:
    """V5: the metadata struct carried with every vector."""
    return chunks.withColumn("metadata", F.struct(
        F.col("doc_id").cast("string").alias("doc_id"), "corpus", "filename",
        F.col("page_num").cast("int").alias("page_num")))


def new_chunks(chunks: DataFrame, existing: DataFrame) -> DataFrame:
    """V3: chunks whose id is not stored yet."""
    return chunks.join(existing.select("chunk_id"), "chunk_id", "left_anti")


def build_report(chunks: DataFrame, existing: DataFrame) -> DataFrame:
    """Existing / processed (new) / total chunk counts: one union of the
    store's ids and the new ids, one aggregate."""
    e = existing.select("chunk_id").distinct().withColumn("_new", F.lit(False))
    n = new_chunks(chunks.select("chunk_id"), existing).withColumn("_new", F.lit(True))
    return e.unionByName(n).agg(
        F.count_if(~F.col("_new")).alias("existing"),
        F.count_if(F.col("_new")).alias("processed"),
        F.count(F.lit(1)).alias("total"))
