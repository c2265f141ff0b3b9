"""Registered round trips through the sinks and readers (I2, I3, I5, I7, I8) and
their SQL twins: tables are written under the shared checkpoint folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.operators import chunks as C
from quarry.operators import explore as X
from quarry.operators import links as L
from quarry.operators import pages as P
from quarry.plans.load_queries import _LINKS, _RECORDS, _plan
from quarry.plans.oracle import TEXT_PAGES, with_
from quarry.plans.text_queries import _CHUNKS, _STRIPPED, _wc
from quarry.session import checkpoint_dir
from quarry.sources import files as IO
from quarry.sources import fixtures as fx

Q: dict = {}
SQL: dict = {}


def register(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def _folder(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("manifest_round_trip", _LINKS + """
SELECT 'web' AS corpus, filename, link AS url, CAST(0 AS INTEGER) AS page_count FROM named
WHERE (page_id, pos) IN (SELECT (page_id, pos) FROM plan WHERE status = 'fetch')""")
def manifest_round_trip(spark, sf):
    """I3 then I2: the manifest rows of a run's fetched links, appended and read."""
    path = _folder(spark, "manifest")
    IO.append_manifest(L.manifest_rows(_plan(spark, sf), "web", "2025-03-18"), path)
    return IO.read_manifest(spark, path).select("corpus", "filename", "url", "page_count")


@register("raw_documents_round_trip", _RECORDS + f"""
SELECT doc_id, page_num, {_wc('t')} AS word_count, redaction_count, md5(t) AS text_md5 FROM records""")
def raw_documents_round_trip(spark, sf):
    """Raw documents written by corpus, read and listed page by page."""
    path = _folder(spark, "raw")
    records = P.page_records(fx.text_pages(spark, sf), fx.star_page_shapes(spark, sf))
    IO.write_table(P.nest_pages(records, fx.text_documents(spark, sf)), path, partition_by=["corpus"])
    return X.document_pages(IO.read_raw_docs(spark, path)).select(
        "doc_id", "page_num", "word_count", "redaction_count", F.md5("text").alias("text_md5"))


@register("redactions_round_trip", _RECORDS + """
SELECT doc_id, page_num, redaction_count, estimated_chars_redacted AS estimated_chars FROM records WHERE redaction_count > 0""")
def redactions_round_trip(spark, sf):
    """The redaction rows of all pages, appended and read."""
    path = _folder(spark, "redactions")
    IO.append_redactions(P.page_records(fx.text_pages(spark, sf), fx.star_page_shapes(spark, sf)), path, "2025-03-18 09:30:00")
    return spark.read.parquet(path).select("doc_id", "page_num", "redaction_count", "estimated_chars")


@register("chunks_round_trip", with_(TEXT_PAGES, _STRIPPED, _CHUNKS) + """
SELECT chunk_id, md5(text) AS text_md5, doc_id, page_num FROM chunks""")
def chunks_round_trip(spark, sf):
    """I8 and V3: chunks of the labelled documents, then what the store lacks of all, appended and read."""
    path = _folder(spark, "chunks")
    chunks = C.with_metadata(C.chunk_text(fx.text_corpus_pages(spark, sf))).withColumn("embedding", F.array(F.lit(1.0).cast("float")))
    labelled = fx.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("doc_id"))
    IO.write_chunks(chunks.join(labelled, chunks["metadata.doc_id"] == labelled["doc_id"], "left_semi"), path)
    IO.write_chunks(C.new_chunks(chunks, spark.read.parquet(path)), path)
    return spark.read.parquet(path).select("chunk_id", F.md5("text").alias("text_md5"), "metadata.doc_id", "metadata.page_num")
