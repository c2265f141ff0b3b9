"""Sources and sinks (I1-I8): file listings, the download manifest, and the
Parquet tables of the star schema, raw documents and chunks.

All reads take explicit schemas (no inference); all writes are task-level
Parquet/CSV writers, so a lost executor only re-runs its own tasks and a
job commit is all-or-nothing per write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.functions.text import basename


def scan_corpora(spark: SparkSession, folders: dict[str, str], with_content: bool = False) -> DataFrame:
    """``*.pdf`` files (case-sensitive suffix, not recursive) of each
    corpus folder: (corpus, path, filename, length, modificationTime[, content]).
    ``binaryFile`` lists in parallel; content is only read when asked for."""
    out = None
    for corpus, folder in folders.items():
        df = (spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf")
              .option("recursiveFileLookup", "false").load(folder))
        cols = [F.lit(corpus).alias("corpus"), "path", basename(F.col("path")).alias("filename"),
                "length", "modificationTime"]
        if with_content:
            cols.append("content")
        df = df.select(*cols)
        out = df if out is None else out.unionByName(df)
    return out


def pdf_gate(files: DataFrame) -> DataFrame:
    """Optional ingest gate: real PDFs start with ``%PDF-``; identical
    payloads share a SHA-256. (An addition: the reference's crawler saved
    one HTML interstitial under hundreds of .pdf names.)"""
    return files.withColumn("is_pdf", F.substring("content", 1, 5) == F.lit(bytearray(b"%PDF-"))) \
        .withColumn("sha256", F.sha2("content", 256))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Known file names of the manifest (column 2), blank rows ignored.
    The file has no header (the reference's reader skips one that its writer
    never writes, losing a row; we do not)."""
    m = spark.read.schema(S.MANIFEST).option("header", "false").csv(path)
    return m.filter(F.col("filename").isNotNull() & (F.length("filename") > 0))


def append_manifest(rows: DataFrame, path: str) -> None:
    """Append (corpus, filename, url, date, page_count) rows."""
    rows.select([f.name for f in S.MANIFEST.fields]).write.mode("append") \
        .option("header", "false").csv(path)


def write_table(df: DataFrame, path: str, mode: str = "append", partition_by=None,
                sort_by=None) -> None:
    """Parquet append, optionally partitioned (e.g. by corpus)
    and clustered within files (e.g. by doc_id) for min/max skipping."""
    w = df
    if sort_by:
        w = w.sortWithinPartitions(*sort_by)
    writer = w.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_raw_docs(spark: SparkSession, path: str) -> DataFrame:
    """Full scan of raw documents, projected to the columns the chunker
    needs (nested pruning keeps other page fields on disk)."""
    return spark.read.schema(S.RAW_DOCS).parquet(path).select("doc_id", "corpus", "filename", "block",
                                                              "pages")


def append_redactions(pages: DataFrame, path: str, created_at=None) -> None:
    """One redaction row per page with at least one redaction."""
    ts = F.localtimestamp() if created_at is None else F.lit(created_at).cast("timestamp_ntz")
    r = pages.filter(F.col("redaction_count") > 0).select(
        F.xxhash64("doc_id", "page_num").alias("id"), "doc_id", "page_num", "redaction_count",
        F.col("estimated_chars_redacted").alias("estimated_chars"), ts.alias("created_at"))
    write_table(r, path, sort_by=["doc_id", "page_num"])


def write_chunks(chunks: DataFrame, path: str, max_records_per_file: int = 1_000_000) -> None:
    """I8: append chunk rows (id, text, embedding, metadata). Batching is the
    task writer's; ``maxRecordsPerFile`` bounds file size."""
    (chunks.select("chunk_id", "text", "embedding", "metadata").write.mode("append")
     .option("maxRecordsPerFile", max_records_per_file).parquet(path))
