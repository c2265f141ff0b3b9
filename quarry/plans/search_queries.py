"""Registered full-text queries (X1-X12) and their SQL twins.

Queries with ``stem=False`` have a DuckDB twin (the tokenizer is a regex
split); the stemmed ones are checked against SQLite FTS5 in the unit tests.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.operators import page_index
from quarry.operators import search as X
from quarry.plans.oracle import PY_WS_CHARS, TEXT_DOCUMENTS, TEXT_PAGES, with_
from quarry.plans.porter_sql import stem_ctes
from quarry.session import checkpoint_dir
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


_UP = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LO = "abcdefghijklmnopqrstuvwxyz"

_OCC = f"""
fts_rows AS (SELECT doc_id, page_num, text FROM text_pages WHERE trim(text, {PY_WS_CHARS}) <> ''),
cols AS (SELECT doc_id, page_num, 'doc_id' AS col, doc_id AS v FROM fts_rows
         UNION ALL SELECT doc_id, page_num, 'page_num', CAST(page_num AS VARCHAR) FROM fts_rows
         UNION ALL SELECT doc_id, page_num, 'text', text FROM fts_rows),
toks AS (SELECT doc_id, page_num, col,
                list_filter(string_split_regex(translate(v, '{_UP}', '{_LO}'),
                                               '[\\x00-/:-@\\[-`{{-\\x7f]+'), lambda x: x <> '') AS t
         FROM cols),
occ AS (SELECT doc_id, page_num, col, unnest(t) AS term, generate_subscripts(t, 1) - 1 AS pos FROM toks)"""

_HEAD = with_(TEXT_DOCUMENTS, TEXT_PAGES, _OCC)


def _result(hits_sql: str, extra: str = "", limit: str = "") -> str:
    return _HEAD + f""",
hits AS ({hits_sql})
SELECT DISTINCT d.id, d.corpus, d.filename, d.page_count, h.page_num
FROM hits h JOIN text_documents d ON h.doc_id = d.id {extra}
ORDER BY d.id, h.page_num {limit}"""


def _pages_with(term_cond: str) -> str:
    return f"SELECT DISTINCT doc_id, page_num FROM occ WHERE {term_cond}"


BUCKETS = 16
_WRITTEN: dict[tuple[str, str], str] = {}  # (application, input) -> folder of its index


def _index(spark, sf, stem=False):
    """The page index of the fixture, written once per application to the
    shared checkpoint folder and read back."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _WRITTEN:
        folder = f"{checkpoint_dir(spark).rstrip('/')}/page-index-{uuid.uuid4().hex}"
        page_index.append_pages(fx.text_pages(spark, sf), folder, BUCKETS, "all")
        _WRITTEN[key] = folder
    return page_index.open_index(spark, _WRITTEN[key], stem)


def _lengths(spark, sf):
    _index(spark, sf)
    return page_index.read_lengths(spark, _WRITTEN[spark.sparkContext.applicationId, sf])


def _run(spark, sf, expr, stem=False, **kw):
    return X.search_pages(_index(spark, sf, stem), fx.text_documents(spark, sf), expr, limit=kw.pop("limit", None), **kw)


def _scan(spark, sf, expr, stem=False):
    """The same search over pages without an index."""
    return X.search_pages(X.PageSource(fx.text_pages(spark, sf), stem=stem), fx.text_documents(spark, sf), expr, limit=None)


@register("tokenize_ascii", _HEAD + """
SELECT doc_id, page_num, col, CAST(count(*) AS INTEGER) AS n_tokens,
       CAST(count(DISTINCT term) AS INTEGER) AS n_distinct
FROM occ GROUP BY doc_id, page_num, col""")
def tokenize_ascii(spark, sf):
    """Token and distinct-token counts per page column."""
    once, twice = X.by_repetition(X.index_pages(fx.text_pages(spark, sf)))
    grouped = X.page_tokens(twice).groupBy("doc_id", "page_num", "col").agg(
        F.count(F.lit(1)).cast("int").alias("n_tokens"),
        F.countDistinct("token").cast("int").alias("n_distinct"))
    return X.token_counts(once).unionByName(grouped)


@register("build_postings", _HEAD + """
SELECT term, doc_id, page_num, col, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS positions
FROM occ GROUP BY term, doc_id, page_num, col""")
def build_postings(spark, sf):
    """X2 without stemming; positions of one (term, page, column) as text."""
    once, twice = X.by_repetition(X.index_pages(fx.text_pages(spark, sf)))
    p = X.build_postings(once, buckets=16, lists="page")
    grouped = (X.build_postings(twice, buckets=16).groupBy("term", "doc_id", "page_num", "col")
               .agg(F.array_sort(F.collect_list("pos")).alias("pos")))
    return (p.select("term", "doc_id", "page_num", "col", "pos").unionByName(grouped)
            .select("term", "doc_id", "page_num", "col", F.array_join("pos", ",").alias("positions")))


_STEMS = """,
vocab AS (SELECT DISTINCT term AS token FROM occ),
asked AS (SELECT token FROM vocab UNION SELECT unnest(['retitioning', 'thes'])),
""" + stem_ctes("asked")


@register("porter_vocabulary", _HEAD + _STEMS + """
SELECT token, term FROM stems WHERE token IN (SELECT token FROM vocab)""")
def porter_vocabulary(spark, sf):
    """Every distinct token of the page index with its Porter stem."""
    t = X.page_tokens(X.index_pages(fx.text_pages(spark, sf)))
    return X.stem_vocabulary(t)


@register("search_term", _result(_pages_with("term = 'and'")))
def search_term(spark, sf):
    return _run(spark, sf, X.Term("and"))


@register("search_and", _result(
    _pages_with("term = 'the'") + " INTERSECT " + _pages_with("term = 'on'")))
def search_and(spark, sf):
    return _run(spark, sf, X.Term("the on"))


@register("search_scan_and_not", _result(
    _pages_with("term = 'the'") + " INTERSECT " + _pages_with("term = 'of'") + " EXCEPT " + _pages_with("term = 'on'")))
def search_scan_and_not(spark, sf):
    """AND and NOT over pages without an index."""
    return _scan(spark, sf, X.Term("the of") - X.Term("on"))


@register("search_or", _result(_pages_with("term IN ('und', 'les')")))
def search_or(spark, sf):
    return _run(spark, sf, X.Term("und") | X.Term("les"))


@register("search_not", _result(
    _pages_with("term = 'the'") + " EXCEPT " + _pages_with("term = 'on'")))
def search_not(spark, sf):
    return _run(spark, sf, X.Term("the") - X.Term("on"))


@register("search_phrase", _result("""
SELECT DISTINCT a.doc_id, a.page_num FROM occ a JOIN occ b
  ON a.doc_id = b.doc_id AND a.page_num = b.page_num AND a.col = b.col AND b.pos = a.pos + 1
WHERE a.term = 'the' AND b.term = 'on'"""))
def search_phrase(spark, sf):
    return _run(spark, sf, X.Phrase("the on"))


@register("search_near", _result("""
SELECT DISTINCT a.doc_id, a.page_num FROM occ a JOIN occ b
  ON a.doc_id = b.doc_id AND a.page_num = b.page_num AND a.col = b.col
WHERE a.term = 'the' AND b.term = 'and' AND abs(a.pos - b.pos) - 1 <= 1"""))
def search_near(spark, sf):
    return _run(spark, sf, X.Near(["the", "and"], 1))


@register("search_near3", _result("""
SELECT DISTINCT a.doc_id, a.page_num FROM occ a
  JOIN occ b ON a.doc_id = b.doc_id AND a.page_num = b.page_num AND a.col = b.col
  JOIN occ c ON a.doc_id = c.doc_id AND a.page_num = c.page_num AND a.col = c.col
WHERE a.term = 'the' AND b.term = 'of' AND c.term = 'and'
  AND greatest(a.pos, b.pos, c.pos) - least(a.pos, b.pos, c.pos) - 1 <= 4"""))
def search_near3(spark, sf):
    return _run(spark, sf, X.Near(["the", "of", "and"], 4))


@register("search_prefix", _result(_pages_with("starts_with(term, 'tha')")))
def search_prefix(spark, sf):
    return _run(spark, sf, X.Prefix("tha"))


@register("search_column", _result(_pages_with("col = 'page_num' AND term = '2'")))
def search_column(spark, sf):
    return _run(spark, sf, X.Col("page_num", X.Term("2")))


@register("search_initial", _result(_pages_with("col = 'text' AND term = 'the' AND pos = 0")))
def search_initial(spark, sf):
    return _run(spark, sf, X.Col("text", X.Initial("the")))


@register("search_corpus_page", _result(_pages_with("term = 'and'"), extra="WHERE d.corpus = 'src1'",
                                        limit="LIMIT 20 OFFSET 20"))
def search_corpus_page(spark, sf):
    return _run(spark, sf, X.Term("and"), corpus="src1", page=2, limit=20)


@register("search_stemmed", _HEAD + _STEMS + """,
hits AS (SELECT o.doc_id, o.page_num FROM occ o JOIN stems s ON s.token = o.term
         WHERE s.term = (SELECT term FROM stems WHERE token = 'retitioning')
            OR starts_with(s.term, (SELECT term FROM stems WHERE token = 'thes')))
SELECT DISTINCT d.id, d.corpus, d.filename, d.page_count, h.page_num
FROM hits h JOIN text_documents d ON h.doc_id = d.id""")
def search_stemmed(spark, sf):
    """Porter mode, as the reference indexes: ``retitioning`` finds every
    word with the stem ``retit``; ``the*`` as a stemmed prefix."""
    return _run(spark, sf, X.Term("retitioning") | X.Prefix("thes"), stem=True)


@register("search_ranked", _HEAD + """,
lengths AS (SELECT doc_id, page_num, count(*) AS n_tokens FROM occ GROUP BY doc_id, page_num),
stats AS (SELECT count(*) AS n_rows, avg(n_tokens) AS avgdl FROM lengths),
f AS (SELECT doc_id, page_num, term, count(*) AS f FROM occ WHERE term IN ('the', 'on')
      GROUP BY doc_id, page_num, term),
nh AS (SELECT term, count(*) AS n FROM f GROUP BY term),
idf AS (SELECT nh.term, greatest(ln((s.n_rows - nh.n + 0.5) / (nh.n + 0.5)), 1e-6) AS idf
        FROM nh, stats s),
hits AS (SELECT doc_id, page_num FROM f GROUP BY doc_id, page_num HAVING count(DISTINCT term) = 2),
scored AS (
  SELECT f.doc_id, f.page_num,
         sum(i.idf * f.f * 2.2 / (f.f + 1.2 * (0.25 + 0.75 * l.n_tokens / s.avgdl))) AS score
  FROM f JOIN idf i ON i.term = f.term JOIN lengths l ON l.doc_id = f.doc_id AND l.page_num = f.page_num,
       stats s
  GROUP BY f.doc_id, f.page_num)
SELECT d.id, d.corpus, d.filename, d.page_count, h.page_num, round(sc.score, 6) AS score
FROM hits h JOIN scored sc ON sc.doc_id = h.doc_id AND sc.page_num = h.page_num
JOIN text_documents d ON d.id = h.doc_id""")
def search_ranked(spark, sf):
    """X4 ranked by BM25 (the ranking the reference's index offers but its
    query does not use): every page with both words, best first."""
    r = X.search_ranked(_index(spark, sf), fx.text_documents(spark, sf), X.Term("the on"), _lengths(spark, sf), limit=None)
    return r.withColumn("score", F.round("score", 6))


@register("search_near_phrase", _result("""
SELECT DISTINCT a.doc_id, a.page_num FROM occ a
  JOIN occ a2 ON a2.doc_id = a.doc_id AND a2.page_num = a.page_num AND a2.col = a.col AND a2.pos = a.pos + 1
  JOIN occ b ON b.doc_id = a.doc_id AND b.page_num = a.page_num AND b.col = a.col
WHERE a.term = 'the' AND a2.term = 'on' AND b.term = 'and'
  AND ((a.pos <= b.pos AND b.pos - (a.pos + 1) - 1 <= 2) OR (b.pos < a.pos AND a.pos - b.pos - 1 <= 2))"""))
def search_near_phrase(spark, sf):
    """X10 with a phrase member: NEAR("the on" and, 2)."""
    return _run(spark, sf, X.Near(["the on", "and"], 2))


@register("search_exclude_column", _result(_pages_with("col <> 'page_num' AND term = '2'")))
def search_exclude_column(spark, sf):
    """X11 with an excluded column: - page_num : 2 (matches ids and text)."""
    return _run(spark, sf, X.Col("page_num", X.Term("2"), exclude=True))
