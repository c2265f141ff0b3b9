"""Registered page, redaction, chunk and mention queries and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import chunks as C
from quarry.operators import explore as X
from quarry.operators import mentions as M
from quarry.operators import pages as P
from quarry.plans.oracle import (PY_WS_CHARS, PY_WS_CLASS, STAR_SHAPES, TEXT_DOCUMENTS, TEXT_PAGES,
                                 with_)
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


def _trim(x):
    return f"trim({x}, {PY_WS_CHARS})"


def _wc(x):
    return f"CAST(CASE WHEN {x} = '' THEN 0 ELSE len(string_split_regex({x}, '{PY_WS_CLASS}+')) END AS INTEGER)"


_STRIPPED = f"""
stripped AS (SELECT doc_id, page_num, {_trim('text')} AS t FROM text_pages)"""


# -- pages -------------------------------------------------------------------

@register("page_facts", with_(TEXT_PAGES, _STRIPPED) + f"""
SELECT doc_id, page_num, CAST(length(t) AS INTEGER) AS n_chars, {_wc('t')} AS word_count,
       md5(t) AS text_md5
FROM stripped""")
def page_facts(spark, sf):
    """P1+P2 over every page of the text fixture."""
    p = P.page_facts(fx.text_pages(spark, sf))
    return p.select("doc_id", "page_num", F.length("text").alias("n_chars"), "word_count",
                    F.md5("text").alias("text_md5"))


@register("scanned_flag", with_(TEXT_PAGES, _STRIPPED) + """
SELECT doc_id, length(t) < 50 AS is_scanned FROM stripped WHERE page_num = 1""")
def scanned_flag(spark, sf):
    return P.scanned_flag(fx.text_pages(spark, sf))


@register("text_based_filter", with_(TEXT_DOCUMENTS, TEXT_PAGES, _STRIPPED) + """
SELECT d.id AS doc_id, d.corpus, d.filename FROM text_documents d
WHERE d.id IN (SELECT doc_id FROM stripped WHERE page_num = 1 AND length(t) > 50)""")
def text_based_filter(spark, sf):
    files = fx.text_documents(spark, sf).select(F.col("id").alias("doc_id"), "corpus", "filename")
    return P.text_based_filter(files, fx.text_pages(spark, sf))


_HIT = """((kind = 'annot' AND annot_type = 12)
       OR (kind = 'drawing' AND fill = [0.0, 0.0, 0.0] AND width > 20 AND height > 8))"""


@register("annot_redactions", with_(STAR_SHAPES) + """
SELECT doc_id, page_num, width, height FROM star_shapes WHERE kind = 'annot' AND annot_type = 12""")
def annot_redactions(spark, sf):
    return P.annot_redactions(fx.star_page_shapes(spark, sf)).select("doc_id", "page_num", "width", "height")


@register("drawing_redactions", with_(STAR_SHAPES) + """
SELECT doc_id, page_num, width, height FROM star_shapes
WHERE kind = 'drawing' AND fill = [0.0, 0.0, 0.0] AND width > 20 AND height > 8""")
def drawing_redactions(spark, sf):
    return P.drawing_redactions(fx.star_page_shapes(spark, sf)).select("doc_id", "page_num", "width",
                                                                        "height")


_PAGE_RED = f"""
page_red AS (
  SELECT doc_id, page_num, CAST(count(*) FILTER (WHERE {_HIT}) AS INTEGER) AS redaction_count,
         CAST(coalesce(sum(CAST(trunc((width / 7) * (height / 12)) AS INTEGER)) FILTER (WHERE {_HIT}), 0)
              AS INTEGER) AS estimated_chars_redacted
  FROM star_shapes GROUP BY doc_id, page_num)"""


@register("page_redactions", with_(STAR_SHAPES, _PAGE_RED) + """
SELECT * FROM page_red""")
def page_redactions(spark, sf):
    return P.page_redactions(fx.star_page_shapes(spark, sf))


@register("document_totals", with_(STAR_SHAPES, _PAGE_RED) + """
SELECT doc_id, CAST(count(*) AS INTEGER) AS page_count,
       CAST(sum(redaction_count) AS BIGINT) AS total_redactions
FROM page_red GROUP BY doc_id""")
def document_totals(spark, sf):
    return P.document_totals(P.page_redactions(fx.star_page_shapes(spark, sf)))


@register("document_pages", with_(TEXT_DOCUMENTS, TEXT_PAGES, _STRIPPED) + f"""
SELECT d.id AS doc_id, d.corpus, d.filename, CAST(count(*) AS INTEGER) AS page_count,
       CAST(sum({_wc('s.t')}) AS BIGINT) AS total_words,
       CAST(sum(CAST(('0x' || substr(md5(s.page_num || ':' || s.t), 1, 12)) AS BIGINT)) AS BIGINT)
         AS pages_digest
FROM text_documents d JOIN stripped s ON s.doc_id = d.id
GROUP BY d.id, d.corpus, d.filename""")
def document_pages(spark, sf):
    """I4 + Q6: the raw-document records of every document (written as page
    blocks), read back and summarised per document: page count, words and an
    order-independent digest of the page texts."""
    pages = P.page_facts(fx.text_pages(spark, sf)).withColumn("redaction_count", F.lit(0)) \
        .withColumn("estimated_chars_redacted", F.lit(0))
    docs = fx.text_documents(spark, sf)
    raw = P.nest_pages(pages, docs)
    st = X.document_page_stats(raw)
    return docs.select(F.col("id").alias("doc_id"), "corpus", "filename").join(st, "doc_id") \
        .select("doc_id", "corpus", "filename", "page_count", "total_words", "pages_digest")


# -- chunks ------------------------------------------------------------------

_CHUNKS = f"""
words AS (SELECT doc_id, page_num, string_split_regex(t, '{PY_WS_CLASS}+') AS w
          FROM stripped WHERE t <> ''),
idx AS (SELECT doc_id, page_num, w,
               unnest(range(0, CAST(ceil(len(w) / 250) AS BIGINT))) AS i FROM words),
chunks AS (SELECT doc_id || '_' || page_num || '_' || i AS chunk_id, doc_id, page_num,
                  CAST(i AS INTEGER) AS chunk_idx,
                  array_to_string(w[i * 250 + 1 : i * 250 + 300], ' ') AS text FROM idx)"""


@register("chunk_text", with_(TEXT_PAGES, _STRIPPED, _CHUNKS) + """
SELECT chunk_id, doc_id, page_num, chunk_idx, CAST(length(text) AS INTEGER) AS n_chars,
       CAST(len(string_split(text, ' ')) AS INTEGER) AS n_words, md5(text) AS text_md5
FROM chunks""")
def chunk_text(spark, sf):
    c = C.chunk_text(fx.text_pages(spark, sf))
    return c.select("chunk_id", "doc_id", "page_num", "chunk_idx", F.length("text").alias("n_chars"),
                    F.size(F.split("text", " ")).alias("n_words"), F.md5("text").alias("text_md5"))


_LABELLED = """
existing AS (SELECT c.chunk_id FROM chunks c
             WHERE c.doc_id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels))"""


def _existing_store(spark, sf):
    """The chunk store as if built earlier for the labelled documents."""
    lab = fx.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("doc_id"))
    return C.chunk_text(fx.text_pages(spark, sf).join(lab, "doc_id", "left_semi")).select("chunk_id")


@register("new_chunks", with_(TEXT_PAGES, _STRIPPED, _CHUNKS, _LABELLED) + """
SELECT chunk_id, doc_id, page_num FROM chunks WHERE chunk_id NOT IN (SELECT chunk_id FROM existing)""")
def new_chunks(spark, sf):
    c = C.chunk_text(fx.text_pages(spark, sf))
    return C.new_chunks(c, _existing_store(spark, sf)).select("chunk_id", "doc_id", "page_num")


@register("build_report", with_(TEXT_PAGES, _STRIPPED, _CHUNKS, _LABELLED) + """
SELECT (SELECT count(*) FROM existing) AS existing,
       (SELECT count(*) FROM chunks WHERE chunk_id NOT IN (SELECT chunk_id FROM existing)) AS processed,
       (SELECT count(*) FROM existing)
         + (SELECT count(*) FROM chunks WHERE chunk_id NOT IN (SELECT chunk_id FROM existing)) AS total""")
def build_report(spark, sf):
    return C.build_report(C.chunk_text(fx.text_pages(spark, sf)), _existing_store(spark, sf))


# -- mentions ----------------------------------------------------------------

# The patterns of the kept types, written for the twin.
_TWIN_PATTERNS = [
    ("PERSON", "[A-Z][a-z][a-z][a-z][a-z]+"),
    ("ORG", "Licensed under [^\\n]+"),
    ("FAC", "\\d{1,3}[.]\\d{1,3}[.]\\d{1,3}[.]\\d{1,3}"),
    ("DATE", "\\d{4}-\\d{2}-\\d{2}"),
]


def _mentions_sql() -> str:
    kept = _TWIN_PATTERNS
    per = " UNION ALL ".join(
        f"SELECT doc_id, page_num, t, '{t}' AS type, regexp_extract_all(c, '{r}', 0) AS ms, "
        f"string_split_regex(c, '{r}') AS ps FROM capped" for t, r in kept)
    return f"""
capped AS (SELECT doc_id, page_num, t, t AS c FROM stripped WHERE t <> ''),
per_type AS ({per}),
xs AS (SELECT doc_id, page_num, t, type, ms, ps, unnest(range(0, len(ms))) AS i FROM per_type),
ys AS (SELECT doc_id, page_num, t, type, ms[i + 1] AS span,
              CAST(coalesce(list_sum(list_transform(ps[1:i + 1], lambda p: length(p))), 0)
                 + coalesce(list_sum(list_transform(ms[1:i], lambda p: length(p))), 0) AS INTEGER) AS st
       FROM xs),
mentions AS (
  SELECT doc_id, page_num, type, {_trim('span')} AS name, st AS start,
         {_trim("replace(substring(t, greatest(0, st - 60) + 1, least(length(t), st + length(span) + 60) - greatest(0, st - 60)), chr(10), ' ')")} AS context
  FROM ys WHERE length({_trim('span')}) >= 2)"""


@register("extract_mentions", with_(TEXT_PAGES, _STRIPPED, _mentions_sql()) + """
SELECT doc_id, page_num, type, name, start, context FROM mentions""")
def extract_mentions(spark, sf):
    """M1-M4 over every page of every document."""
    return M.extract_mentions(fx.text_pages(spark, sf)) \
        .select("doc_id", "page_num", "type", "name", "start", "context")


_WHOLE_PAGES = """
text_pages AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, 1 AS page_num, text FROM documents)"""


@register("extract_mentions_whole", with_(_WHOLE_PAGES, _STRIPPED, _mentions_sql()) + """
SELECT doc_id, page_num, type, name, start, context FROM mentions""")
def extract_mentions_whole(spark, sf):
    """M1-M4 over whole documents as single pages, however long."""
    docs = fx.table(spark, sf, "documents")
    return M.extract_mentions(docs.select(F.col("doc_id").cast("string").alias("doc_id"),
                                          F.lit(1).alias("page_num"), "text"))


@register("distinct_entities_preview", with_(TEXT_PAGES, _STRIPPED, _mentions_sql()) + """
SELECT doc_id, type, name, arg_min(page_num, page_num * 100000 + start) AS first_page,
       arg_min(start, page_num * 100000 + start) AS first_start
FROM mentions GROUP BY doc_id, type, name""")
def distinct_entities_preview(spark, sf):
    return M.distinct_entities_preview(M.extract_mentions(fx.text_pages(spark, sf)))


@register("mention_count_report", with_(TEXT_PAGES, _STRIPPED, _mentions_sql()) + """
SELECT doc_id, count(*) AS mentions FROM mentions GROUP BY doc_id""")
def mention_count_report(spark, sf):
    return M.mention_count_report(M.extract_mentions(fx.text_pages(spark, sf)))


@register("explode_pages", with_(TEXT_PAGES, _STRIPPED) + """
SELECT doc_id, page_num, CAST(length(t) AS INTEGER) AS n_chars, md5(t) AS text_md5 FROM stripped""")
def explode_pages(spark, sf):
    """I4 then P1: pages nested into raw-document records, exploded back to one
    stripped page per row, numbered from 1 by position."""
    pages = P.page_facts(fx.text_pages(spark, sf)).withColumn("redaction_count", F.lit(0)) \
        .withColumn("estimated_chars_redacted", F.lit(0))
    raw = P.nest_pages(pages, fx.text_documents(spark, sf))
    return P.explode_pages(raw).select("doc_id", "page_num", F.length("text").alias("n_chars"),
                                       F.md5("text").alias("text_md5"))
