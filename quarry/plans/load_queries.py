"""Registered link-harvest (L1-L6) and load-path (D1-D8) queries and twins.

Load fixture: the text documents are the candidate files of a run; the
labelled documents (and the entities of their mentions) count as loaded by
an earlier run.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.scratch import materialize
from quarry.operators import links as L
from quarry.operators import load as D
from quarry.operators import mentions as M
from quarry.operators import pages as P
from quarry.plans.oracle import (STAR_DOCUMENTS, STAR_ENTITIES, STAR_MENTIONS, STAR_REDACTIONS, STAR_RELEASES,
                                 STAR_SHAPES, TEXT_DOCUMENTS, TEXT_PAGES, with_)
from quarry.plans.text_queries import _PAGE_RED, _STRIPPED, _mentions_sql, _wc
from quarry.sources import fixtures as fx

Q: dict = {}
SQL: dict = {}

BASE = "https://www.example.org"
RUN_TIME = "2025-03-18 09:30:00"


def register(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


# -- links -------------------------------------------------------------------

# The generated pages write every anchor as <a href="...">, outside scripts and
# comments; the twin cuts them at that text instead of matching tags.
_LINKS = """
WITH pieces AS (SELECT page_id, url, string_split(html, '<a href="') AS ps FROM pages),
raw AS (SELECT page_id, url, unnest(ps[2:]) AS piece, generate_subscripts(ps[2:], 1) - 1 AS pos FROM pieces),
l1 AS (SELECT 'web' AS source, page_id, url, CAST(pos AS INTEGER) AS pos,
              replace(replace(replace(replace(replace(substr(piece, 1, instr(piece, '"') - 1), '&lt;', '<'),
                '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&') AS href FROM raw),
links AS (SELECT *, CASE WHEN starts_with(href, 'http') THEN href
                         ELSE 'https://www.example.org' || href END AS link FROM l1),
named AS (SELECT *, url_decode(replace(split_part(string_split(link, '/')[-1], '?', 1), '+', '%2B'))
                    AS filename FROM links),
known AS (SELECT filename FROM named WHERE url LIKE '%//blog.%' UNION SELECT filename FROM named WHERE url LIKE '%/de/%'),
plan AS (SELECT page_id, pos, filename, source,
                CASE WHEN row_number() OVER (PARTITION BY filename ORDER BY page_id, pos) = 1
                          AND filename NOT IN (SELECT filename FROM known) THEN 'fetch' ELSE 'skip' END AS status
         FROM named)
"""


def _links(spark, sf, needle=None):
    return L.absolutize_links(L.extract_links(fx.fetched_pages(spark, sf), needle), BASE)


@register("extract_links", _LINKS + "SELECT page_id, pos, href, link FROM links")
def extract_links(spark, sf):
    """L1+L2: every anchor of every fetched page, made absolute."""
    return _links(spark, sf).select("page_id", "pos", "href", "link")


@register("pdf_links", _LINKS + "SELECT page_id, pos, href, link FROM links WHERE lower(href) LIKE '%ion%'")
def pdf_links(spark, sf):
    """L1 with a needle (``.pdf`` in the reference; ``ion`` on these pages)."""
    return _links(spark, sf, needle="ion").select("page_id", "pos", "href", "link")


@register("index_page_links", _LINKS + """
SELECT link, arg_min(page_id, page_id * 100000 + pos) AS first_page,
       arg_min(pos, page_id * 100000 + pos) AS first_pos
FROM links WHERE contains(link, '/th') AND NOT contains(link, 'the') GROUP BY link""")
def index_page_links(spark, sf):
    """L3: distinct sub-page links (contain ``/th``, not ``the``), first seen."""
    return L.index_page_links(_links(spark, sf), "/th", "the")


@register("url_filename", _LINKS + "SELECT page_id, pos, filename FROM named")
def url_filename(spark, sf):
    """L4 with percent-decoding."""
    return L.with_filenames(_links(spark, sf), decode=True).select("page_id", "pos", "filename")


def _plan(spark, sf):
    """The plan of a run after which the blogs' links are in the manifest and
    the links of German pages lie on disk."""
    named = materialize(L.with_filenames(_links(spark, sf), decode=True), "links")
    return L.plan_downloads(named, named.where("url LIKE '%//blog.%'").select("filename"),
                            named.where("url LIKE '%/de/%'").select("filename"))


@register("plan_downloads", _LINKS + "SELECT page_id, pos, filename, status FROM plan")
def plan_downloads(spark, sf):
    """The first link per new file name is fetched; repeats, names in the
    manifest and names on disk are skipped."""
    return _plan(spark, sf).select("page_id", "pos", "filename", "status")


@register("harvest_counts", _LINKS + """
SELECT source, count(*) AS found, count(*) FILTER (WHERE status = 'fetch') AS to_fetch,
       count(*) FILTER (WHERE status = 'skip') AS skipped FROM plan GROUP BY source""")
def harvest_counts(spark, sf):
    """L6."""
    return L.harvest_counts(_plan(spark, sf))


# -- load --------------------------------------------------------------------

def _loaded(spark, sf):
    """What an earlier run left: documents and entities of the labelled files."""
    lab = fx.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("doc_id"))
    docs = _files(spark, sf).join(lab, "doc_id", "left_semi").select(F.col("doc_id").alias("id"), "filename")
    mentions = M.extract_mentions(fx.text_pages(spark, sf).join(lab, "doc_id", "left_semi"))
    return docs, D.upsert_entities(mentions, None, RUN_TIME)


def _files(spark, sf):
    return fx.text_documents(spark, sf).select(F.col("id").alias("doc_id"), "corpus", "filename",
                                               "file_path", "page_count")


def _run(spark, sf):
    return D.ingest_batch(_files(spark, sf), fx.text_pages(spark, sf), *_loaded(spark, sf), RUN_TIME,
                          shapes=fx.star_page_shapes(spark, sf))


_LOAD = with_(TEXT_DOCUMENTS, TEXT_PAGES, _STRIPPED, _mentions_sql()) + """,
loaded AS (SELECT d.id, d.filename FROM text_documents d
           WHERE d.id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)),
candidates AS (SELECT d.id AS doc_id, d.corpus, d.filename, d.file_path, d.page_count
               FROM text_documents d
               WHERE d.id IN (SELECT doc_id FROM stripped WHERE page_num = 1 AND length(t) > 50)
                  OR d.id IN (SELECT id FROM loaded)),
fresh AS (SELECT * FROM candidates WHERE filename NOT IN (SELECT filename FROM loaded)),
old_entities AS (SELECT DISTINCT name, type FROM mentions WHERE doc_id IN (SELECT id FROM loaded)),
new_mentions AS (SELECT * FROM mentions WHERE doc_id IN (SELECT doc_id FROM fresh)),
counts AS (SELECT doc_id, count(*) AS n FROM new_mentions GROUP BY doc_id),
status AS (
  SELECT c.doc_id, c.corpus, c.filename,
         CASE WHEN c.filename IN (SELECT filename FROM loaded) THEN 'skipped' ELSE 'ok' END AS status,
         c.page_count
  FROM candidates c),
status2 AS (
  SELECT s.doc_id, s.corpus, s.filename, s.status,
         CASE WHEN s.status = 'ok' THEN s.page_count END AS pages,
         CAST(CASE WHEN s.status = 'ok' THEN coalesce(n.n, 0) END AS BIGINT) AS mentions
  FROM status s LEFT JOIN counts n ON n.doc_id = s.doc_id)
"""


@register("ingest_status", _LOAD + "SELECT * FROM status2")
def ingest_status(spark, sf):
    """Status per text-based candidate file of the run."""
    return _run(spark, sf)["status"]


@register("skip_ingested", _LOAD + """
SELECT id AS doc_id, corpus, filename FROM text_documents WHERE filename NOT IN (SELECT filename FROM loaded)""")
def skip_ingested(spark, sf):
    """Files not loaded before."""
    return D.skip_ingested(_files(spark, sf), _loaded(spark, sf)[0]).select("doc_id", "corpus", "filename")


@register("upsert_documents", _LOAD + """
SELECT doc_id AS id, corpus, filename, file_path, page_count,
       TIMESTAMP '2025-03-18 09:30:00' AS created_at FROM fresh""")
def upsert_documents(spark, sf):
    """Rows appended to documents."""
    return _run(spark, sf)["documents"].select("id", "corpus", "filename", "file_path", "page_count",
                                               "created_at")


@register("upsert_entities", _LOAD + """
SELECT name, type, count(*) AS mentions FROM new_mentions
WHERE (name, type) NOT IN (SELECT (name, type) FROM old_entities) GROUP BY name, type""")
def upsert_entities(spark, sf):
    """New (name, type) pairs of the run, with the mentions that carry their id."""
    run = _run(spark, sf)
    counts = run["mentions"].groupBy(F.col("entity_id").alias("id")).agg(F.count(F.lit(1)).alias("mentions"))
    return run["entities"].join(counts, "id").select("name", "type", "mentions")


@register("load_mentions", _LOAD + """
SELECT doc_id, page_num, name, type, context, count(*) AS n, count(*) AS ids
FROM new_mentions GROUP BY doc_id, page_num, name, type, context""")
def load_mentions(spark, sf):
    """D3: mention rows appended, through their entity ids, and their own ids counted."""
    run, (_, old) = _run(spark, sf), _loaded(spark, sf)
    entities = old.unionByName(run["entities"]).select(F.col("id").alias("entity_id"), "name", "type")
    return (run["mentions"].join(entities, "entity_id").groupBy("doc_id", "page_num", "name", "type", "context")
            .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids")))


_RECORDS = with_(TEXT_DOCUMENTS, TEXT_PAGES, _STRIPPED, STAR_SHAPES, _PAGE_RED) + """,
records AS (SELECT s.doc_id, s.page_num, s.t, coalesce(r.redaction_count, 0) AS redaction_count,
                   coalesce(r.estimated_chars_redacted, 0) AS estimated_chars_redacted
            FROM stripped s LEFT JOIN page_red r ON r.doc_id = s.doc_id AND r.page_num = s.page_num),
new_records AS (SELECT * FROM records
                WHERE doc_id IN (SELECT doc_id FROM stripped WHERE page_num = 1 AND length(t) > 50)
                  AND doc_id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels))
"""


@register("page_records", _RECORDS + f"""
SELECT doc_id, page_num, {_wc('t')} AS word_count, redaction_count, estimated_chars_redacted, md5(t) AS text_md5
FROM records""")
def page_records(spark, sf):
    """P1, P2 and P7 as one record per page, pages without shapes included."""
    r = P.page_records(fx.text_pages(spark, sf), fx.star_page_shapes(spark, sf))
    return r.select("doc_id", "page_num", "word_count", "redaction_count", "estimated_chars_redacted",
                    F.md5("text").alias("text_md5"))


@register("load_raw_documents", _RECORDS + f"""
SELECT doc_id, CAST((page_num - 1) // 256 AS INTEGER) AS block, CAST(count(*) AS INTEGER) AS pages,
       CAST(sum({_wc('t')}) AS BIGINT) AS words, CAST(sum(redaction_count) AS BIGINT) AS redactions
FROM new_records GROUP BY doc_id, (page_num - 1) // 256""")
def load_raw_documents(spark, sf):
    """The raw-document records that a load run writes."""
    total = lambda f: F.aggregate("pages", F.lit(0).cast("long"), lambda a, p: a + p[f])
    return _run(spark, sf)["raw_docs"].select("doc_id", "block", F.size("pages").alias("pages"),
                                              total("word_count").alias("words"), total("redaction_count").alias("redactions"))


@register("load_page_index", _RECORDS + """
SELECT doc_id, page_num, md5(t) AS text_md5 FROM new_records WHERE t <> ''""")
def load_page_index(spark, sf):
    """The page-index rows that a load run writes."""
    return _run(spark, sf)["page_index"].select("doc_id", "page_num", F.md5("text").alias("text_md5"))


@register("load_redactions", _RECORDS + """
SELECT doc_id, page_num, redaction_count, estimated_chars_redacted AS estimated_chars
FROM new_records WHERE redaction_count > 0""")
def load_redactions(spark, sf):
    """The redaction rows that a load run writes."""
    return _run(spark, sf)["redactions"].select("doc_id", "page_num", "redaction_count", "estimated_chars")


@register("run_release", _LOAD + """
SELECT c.corpus, TIMESTAMP '2025-03-18 09:30:00' AS run_date,
       CAST(coalesce(r.docs_added, 0) AS BIGINT) AS docs_added,
       CAST(coalesce(r.entities_found, 0) AS BIGINT) AS entities_found,
       CAST(coalesce(de.n, 0) AS BIGINT) AS distinct_entities,
       'Ingestion run 2025-03-18 09:30' AS notes
FROM (SELECT DISTINCT corpus FROM text_documents) c
LEFT JOIN (SELECT corpus, count(*) AS docs_added, sum(mentions) AS entities_found
           FROM status2 WHERE status = 'ok' GROUP BY corpus) r ON r.corpus = c.corpus
LEFT JOIN (SELECT s.corpus, count(DISTINCT (m.name, m.type)) AS n
           FROM new_mentions m JOIN status2 s ON s.doc_id = m.doc_id AND s.status = 'ok'
           GROUP BY s.corpus) de ON de.corpus = c.corpus""")
def run_release(spark, sf):
    """One release row per corpus (entities_found counts mentions, as the
    reference does; distinct_entities is the distinct (name, type) count)."""
    return _run(spark, sf)["releases"]


@register("run_totals", _LOAD + """
SELECT count(*) FILTER (WHERE status = 'ok') AS total_docs,
       count(*) FILTER (WHERE status = 'skipped') AS skipped,
       count(*) FILTER (WHERE status = 'error') AS errors,
       count(*) FILTER (WHERE status = 'scanned') AS scanned,
       count(*) FILTER (WHERE status = 'empty') AS empty FROM status2""")
def run_totals(spark, sf):
    """D7."""
    return _run(spark, sf)["totals"]


def _dup(table: str, keys: str, rule: str) -> str:
    return (f"SELECT '{rule}' AS rule, CAST(coalesce((SELECT sum(n - 1) FROM (SELECT count(*) n FROM {table} "
            f"GROUP BY {keys}) WHERE n > 1), 0) AS BIGINT) AS violations")


def _orphan(table: str, key: str, parent: str, rule: str) -> str:
    return f"SELECT '{rule}', (SELECT count(*) FROM {table} WHERE {key} NOT IN (SELECT id FROM {parent}))"


@register("integrity_audit", with_(STAR_DOCUMENTS, STAR_ENTITIES, STAR_MENTIONS, STAR_REDACTIONS, STAR_RELEASES)
          + " UNION ALL ".join([
              _dup("star_documents", "id", "documents.id unique"),
              _dup("star_documents", "filename", "documents.filename unique"),
              _dup("star_entities", "id", "entities.id unique"),
              _dup("star_entities", "name, type", "entities.(name,type) unique"),
              _dup("lineitem", "l_orderkey, l_linenumber, l_partkey, l_suppkey", "mentions.id unique"),
              _dup("star_redactions", "doc_id, page_num", "redactions.id unique"),
              _dup("star_releases", "id", "releases.id unique"),
              _orphan("star_mentions", "entity_id", "star_entities", "mentions.entity_id -> entities"),
              _orphan("star_mentions", "doc_id", "star_documents", "mentions.doc_id -> documents"),
              _orphan("star_redactions", "doc_id", "star_documents", "redactions.doc_id -> documents")]))
def integrity_audit(spark, sf):
    """D8 over the star tables."""
    return D.integrity_audit(fx.star_documents(spark, sf), fx.star_entities(spark, sf), fx.star_mentions(spark, sf),
                             fx.star_redactions(spark, sf), fx.star_releases(spark, sf))


# -- streaming ---------------------------------------------------------------

@register("stream_ingest", with_(TEXT_DOCUMENTS, TEXT_PAGES, _STRIPPED, _mentions_sql()) + """,
counts AS (SELECT doc_id, count(*) AS n FROM mentions GROUP BY doc_id),
files AS (SELECT d.id, d.corpus, coalesce(c.n, 0) AS n,
                 d.id IN (SELECT doc_id FROM stripped WHERE page_num = 1 AND length(t) > 50) AS good,
                 d.id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels) AS early
          FROM text_documents d LEFT JOIN counts c ON c.doc_id = d.id)
SELECT CAST(0 AS BIGINT) AS batch_id, corpus, count(*) FILTER (WHERE good) AS docs_added,
       CAST(coalesce(sum(n) FILTER (WHERE good), 0) AS BIGINT) AS entities_found, CAST(0 AS BIGINT) AS skipped
FROM files WHERE early GROUP BY corpus
UNION ALL
SELECT 1, corpus, count(*) FILTER (WHERE good AND NOT early),
       CAST(coalesce(sum(n) FILTER (WHERE good AND NOT early), 0) AS BIGINT), count(*) FILTER (WHERE good AND early)
FROM files GROUP BY corpus""")
def stream_ingest(spark, sf):
    """T1+T2: the text documents dropped as input files in two waves -- first
    the labelled documents, then all of them (so the second repeats every file
    name of the first) -- ingested by two ``availableNow`` runs of the
    streaming load; the result is the release log of both runs with the number
    of files that each skipped.
    Input, store and checkpoint live under the session's checkpoint folder."""
    from quarry.streaming.ingest import read_store

    store = _two_waves(spark, sf)
    skipped = (read_store(spark, store, "status").groupBy("batch_id", "corpus")
               .agg(F.count_if(F.col("status") == "skipped").alias("skipped")))
    return (read_store(spark, store, "releases").join(skipped, ["batch_id", "corpus"], "left")
            .select(F.col("batch_id").cast("long").alias("batch_id"), "corpus", "docs_added", "entities_found",
                    F.coalesce("skipped", F.lit(0)).alias("skipped")))


def _two_waves(spark, sf, index_buckets=None):
    """The store after two runs of the stream: the labelled documents, then all of them."""
    import uuid

    from quarry.session import checkpoint_dir
    from quarry.streaming.ingest import raw_input_from_pages
    from quarry.streaming.ingest import stream_ingest as run

    root = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    files = fx.text_documents(spark, sf).select(F.col("id").alias("doc_id"), "corpus", "filename",
                                                "file_path")
    pages = fx.text_pages(spark, sf)
    lab = fx.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("doc_id"))
    for wave, some in enumerate((pages.join(lab, "doc_id", "left_semi"), pages), 1):  # then everything again: repeats + new
        rows = raw_input_from_pages(some, files)
        rows.write.parquet(f"{root}/src/wave={wave}")
        run(spark, f"{root}/src", f"{root}/store", checkpoint=f"{root}/ckpt", index_buckets=index_buckets).awaitTermination()
    return f"{root}/store"


@register("search_after_stream", with_(TEXT_DOCUMENTS, TEXT_PAGES, _STRIPPED) + """
SELECT d.id, d.corpus, d.filename, s.page_num
FROM stripped s JOIN text_documents d ON d.id = s.doc_id
WHERE d.id IN (SELECT doc_id FROM stripped WHERE page_num = 1 AND length(t) > 50)
  AND regexp_matches(lower(s.t), '(^|[^0-9a-z\\x{80}-\\x{10FFFF}])the[^0-9a-z\\x{80}-\\x{10FFFF}]+on([^0-9a-z\\x{80}-\\x{10FFFF}]|$)')""")
def search_after_stream(spark, sf):
    """A phrase searched in the index that two runs of the stream kept."""
    from quarry.operators import search as X
    from quarry.streaming.ingest import open_store_index, read_store

    store = _two_waves(spark, sf, index_buckets=8)
    found = X.search_pages(open_store_index(spark, store, stem=False), read_store(spark, store, "documents"), X.Phrase("the on"), limit=None)
    return found.select("id", "corpus", "filename", "page_num")
