"""Page and redaction facts (P1-P8) and the nested raw-document record (I4).

The PDF parser itself is not rebuilt: its outputs (page text and page shapes)
are this module's input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import schemas as S
from quarry.functions.text import py_strip, py_word_count


def explode_pages(raw_docs: DataFrame) -> DataFrame:
    """Nested document records -> one row per page (page_num from 1, as
    stored), text stripped, with the page's facts. ``pages`` must hold the page
    records of ``schemas.RAW_DOCS``."""
    element = getattr(raw_docs.schema["pages"].dataType, "elementType", None)
    if not isinstance(element, T.StructType) or not set(S.PAGE.names) <= set(element.names):
        raise ValueError("pages must be an array of page records, as in schemas.RAW_DOCS")
    return (raw_docs.select("doc_id", F.explode("pages").alias("_p"))
            .select("doc_id", F.col("_p.page_num").alias("page_num"),
                    py_strip(F.col("_p.text")).alias("text"),
                    F.col("_p.redaction_count").alias("redaction_count"),
                    F.col("_p.estimated_chars_redacted").alias("estimated_chars_redacted"),
                    F.col("_p.word_count").alias("word_count")))


def page_facts(pages: DataFrame) -> DataFrame:
    """P1+P2: stripped text and its word count (0 when empty)."""
    t = py_strip(F.coalesce(F.col("text"), F.lit("")))
    return pages.withColumn("text", t).withColumn("word_count", py_word_count(F.col("text")))


def first_pages(pages: DataFrame) -> DataFrame:
    """Stripped text of page 1 of every document (page_num is a pushed filter)."""
    return pages.filter(F.col("page_num") == 1).select("doc_id", py_strip("text").alias("text"))


def scanned_flag(pages: DataFrame) -> DataFrame:
    """A document is scanned when its first page has < 50 characters."""
    return first_pages(pages).select(
        "doc_id", (F.length("text") < S.SCANNED_BELOW).alias("is_scanned"))


def text_based_filter(files: DataFrame, pages: DataFrame) -> DataFrame:
    """Keep files whose first page has > 50 characters (a 50-character
    page is neither text-based nor scanned, as in the reference).
    Files without a readable first page are dropped, as the reference drops
    unreadable files."""
    keep = first_pages(pages).filter(F.length("text") > S.TEXT_BASED_ABOVE).select("doc_id")
    return files.join(keep, "doc_id", "left_semi")


def _is_annot_redaction():
    return (F.col("kind") == "annot") & (F.col("annot_type") == S.REDACT_ANNOT_TYPE)


def _is_drawing_redaction():
    black = F.col("fill") == F.array(*[F.lit(0.0)] * 3)
    return ((F.col("kind") == "drawing") & black & (F.col("width") > S.REDACT_MIN_WIDTH)
            & (F.col("height") > S.REDACT_MIN_HEIGHT))


def _hidden_chars():
    # int() truncates; so does Spark's cast (DuckDB's rounds: use trunc there).
    return ((F.col("width") / S.CHAR_CELL_WIDTH) * (F.col("height") / S.CHAR_CELL_HEIGHT)).cast("int")


def annot_redactions(shapes: DataFrame) -> DataFrame:
    """P5: redaction annotations, any size."""
    return shapes.filter(_is_annot_redaction())


def drawing_redactions(shapes: DataFrame) -> DataFrame:
    """Black filled rectangles wider than 20 and taller than 8."""
    return shapes.filter(_is_drawing_redaction())


def page_redactions(shapes: DataFrame) -> DataFrame:
    """Per page, number of redaction marks (a mark drawn both ways counts
    twice) and hidden characters; pages whose shapes hold no mark get 0.
    One aggregation, combined map-side."""
    hit = _is_annot_redaction() | _is_drawing_redaction()
    return shapes.groupBy("doc_id", "page_num").agg(
        F.count_if(hit).cast("int").alias("redaction_count"),
        F.coalesce(F.sum(F.when(hit, _hidden_chars())), F.lit(0)).cast("int")
        .alias("estimated_chars_redacted"))


def page_records(pages: DataFrame, shapes: DataFrame | None = None) -> DataFrame:
    """The full record of every page: stripped text, word count, and the
    redactions and hidden characters of its shapes (0 where it has none)."""
    facts = page_facts(pages)
    if shapes is None:
        return facts.withColumn("redaction_count", F.lit(0)).withColumn("estimated_chars_redacted", F.lit(0))
    return (facts.join(page_redactions(shapes), ["doc_id", "page_num"], "left")
            .withColumn("redaction_count", F.coalesce("redaction_count", F.lit(0)))
            .withColumn("estimated_chars_redacted", F.coalesce("estimated_chars_redacted", F.lit(0))))


def document_totals(page_rows: DataFrame) -> DataFrame:
    """Page count and total redactions per document."""
    return page_rows.groupBy("doc_id").agg(
        F.count(F.lit(1)).cast("int").alias("page_count"),
        F.coalesce(F.sum("redaction_count"), F.lit(0)).cast("long").alias("total_redactions"))


NO_BLOCK = -1 << 31  # of a page without a number, in joins
RAW_BLOCK_PAGES = 256  # part of the raw-document schema: pages of a record at most


def nest_pages(pages: DataFrame, docs: DataFrame, block_pages: int = RAW_BLOCK_PAGES) -> DataFrame:
    """I4: nested raw-document records: document attributes + a page list in
    page order. ``pages`` has doc_id, page_num, text, redaction_count,
    estimated_chars_redacted, word_count.

    A document's pages are cut into blocks of at most ``block_pages`` pages
    (one record per block, ``block`` from 0), so no record -- and no group
    collected by one task -- grows with the size of a document; an ordinary
    document is a single record. ``page_count`` is the document's total.

    The texts are shuffled once: the document's attributes meet a record by its
    document and block, as the record's pages did."""
    block = F.coalesce(F.floor((F.col("page_num") - 1) / block_pages).cast("int"), F.lit(NO_BLOCK)).alias("_block")
    per = pages.groupBy("doc_id", block).agg(F.array_sort(F.collect_list(F.struct(
        F.col("page_num").cast("int").alias("page_num"), "text",
        F.col("redaction_count").cast("int").alias("redaction_count"),
        F.col("estimated_chars_redacted").cast("int").alias("estimated_chars_redacted"),
        F.col("word_count").cast("int").alias("word_count")))).alias("pages"))
    sizes = pages.groupBy("doc_id", block).agg(F.count(F.lit(1)).alias("n"))
    counts = sizes.groupBy("doc_id").agg(F.sum("n").cast("int").alias("page_count"))
    d = docs.select(F.col("id").alias("doc_id"), "corpus", "filename", "file_path")
    records = d.join(counts, "doc_id").join(sizes.select("doc_id", "_block"), "doc_id")
    return (records.join(per, ["doc_id", "_block"])
            .select("doc_id", "corpus", "filename", "file_path", "page_count",
                    F.nullif("_block", F.lit(NO_BLOCK)).alias("block"), "pages"))


def page_digest(page_num, text):
    """48-bit page digest (md5 of ``page_num:text``); summed per document it
    gives an order-independent fingerprint without collecting the pages."""
    h = F.md5(F.concat_ws(":", page_num.cast("string"), text))
    return F.conv(F.substring(h, 1, 12), 16, 10).cast("long")
