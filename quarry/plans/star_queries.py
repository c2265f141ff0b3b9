"""Registered star-schema queries (Q1-Q17, I9) and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import explore as X
from quarry.operators.load import release_log
from quarry.plans.oracle import (STAR_DOCUMENTS, STAR_ENTITIES, STAR_MENTIONS, STAR_PAGE_COUNT,
                                 STAR_REDACTIONS, STAR_RELEASES, STAR_SUPPLIER_MENTIONS, with_)
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


_DOCS_PC = with_(STAR_DOCUMENTS, STAR_PAGE_COUNT) + ""
_DOC_COLS = "d.id, d.corpus, d.filename, p.page_count, d.is_scanned, d.created_at"


@register("list_documents", _DOCS_PC + f"""
SELECT {_DOC_COLS} FROM star_documents d JOIN star_page_count p ON p.ok = d.ok
ORDER BY d.created_at DESC, d.id LIMIT 20 OFFSET 20""")
def list_documents(spark, sf):
    return X.list_documents(fx.star_documents(spark, sf, with_page_count=True), page=2, limit=20)


@register("list_documents_corpus", _DOCS_PC + f"""
SELECT {_DOC_COLS} FROM star_documents d JOIN star_page_count p ON p.ok = d.ok
WHERE d.corpus = '1-URGENT' ORDER BY d.created_at DESC, d.id LIMIT 100 OFFSET 100""")
def list_documents_corpus(spark, sf):
    return X.list_documents(fx.star_documents(spark, sf, with_page_count=True),
                            corpus="1-URGENT", page=2, limit=100)


@register("documents_deep_page", _DOCS_PC + f"""
SELECT {_DOC_COLS} FROM star_documents d JOIN star_page_count p ON p.ok = d.ok
ORDER BY d.created_at DESC, d.id LIMIT 20 OFFSET 780""")
def documents_deep_page(spark, sf):
    """Q17: the fortieth page of a stored order, newest first: the parts that hold it are all that is read."""
    import uuid

    from quarry.functions.paging import numbered_page, store_order
    from quarry.session import checkpoint_dir

    path = f"{checkpoint_dir(spark).rstrip('/')}/document-order-{uuid.uuid4().hex}"
    store_order(fx.star_documents(spark, sf, with_page_count=True), [("created_at", False), "id"], path)
    return numbered_page(spark, path, 40, 20).select("id", "corpus", "filename", "page_count", "is_scanned", "created_at")


@register("count_documents", with_(STAR_DOCUMENTS) + """
SELECT count(*) AS total FROM star_documents""")
def count_documents(spark, sf):
    return X.count_documents(fx.star_documents(spark, sf))


@register("count_documents_corpus", with_(STAR_DOCUMENTS) + """
SELECT count(*) AS total FROM star_documents WHERE corpus = '5-LOW'""")
def count_documents_corpus(spark, sf):
    return X.count_documents(fx.star_documents(spark, sf), corpus="5-LOW")


_DOC_ENTS = """
doc_ents AS (
  SELECT m.doc_id, e.name, e.type, count(*) AS mentions,
         row_number() OVER (PARTITION BY m.doc_id ORDER BY count(*) DESC, e.name, e.type) AS rn
  FROM star_mentions m JOIN star_entities e ON m.entity_id = e.id
  GROUP BY m.doc_id, e.name, e.type)"""


@register("document_entities", with_(STAR_MENTIONS, STAR_ENTITIES, _DOC_ENTS) + """
SELECT doc_id, name, type, mentions FROM doc_ents WHERE rn <= 20""")
def document_entities(spark, sf):
    return X.document_entities(fx.star_mentions(spark, sf), fx.star_entities(spark, sf))


@register("document_redactions", with_(STAR_REDACTIONS) + """
SELECT doc_id, page_num, redaction_count, estimated_chars FROM star_redactions""")
def document_redactions(spark, sf):
    return X.document_redactions(fx.star_redactions(spark, sf))


@register("document_profile", with_(STAR_DOCUMENTS, STAR_PAGE_COUNT, STAR_MENTIONS, STAR_ENTITIES,
                                    STAR_REDACTIONS, _DOC_ENTS) + """
SELECT d.id, d.corpus, d.filename, p.page_count,
       CAST(coalesce(e.n_entities, 0) AS INTEGER) AS n_entities,
       coalesce(e.entities_text, '') AS entities_text,
       CAST(coalesce(r.redacted_pages, 0) AS INTEGER) AS redacted_pages,
       CAST(coalesce(r.total_redactions, 0) AS BIGINT) AS total_redactions,
       CAST(coalesce(r.total_chars, 0) AS BIGINT) AS total_chars
FROM star_documents d
JOIN star_page_count p ON p.ok = d.ok
LEFT JOIN (SELECT doc_id, count(*) AS n_entities,
                  string_agg(name || ':' || type || ':' || mentions, ';'
                             ORDER BY mentions DESC, name, type) AS entities_text
           FROM doc_ents WHERE rn <= 20 GROUP BY doc_id) e ON e.doc_id = d.id
LEFT JOIN (SELECT doc_id, count(*) AS redacted_pages, sum(redaction_count) AS total_redactions,
                  sum(estimated_chars) AS total_chars
           FROM star_redactions GROUP BY doc_id) r ON r.doc_id = d.id""")
def document_profile(spark, sf):
    """Q7 in bulk: every document with its top-20 entities (as text, in rank
    order) and its redaction aggregates."""
    p = X.document_profile(fx.star_documents(spark, sf, with_page_count=True),
                           fx.star_mentions(spark, sf), fx.star_entities(spark, sf),
                           fx.star_redactions(spark, sf))
    ent = F.transform("entities", lambda x: F.concat_ws(":", x["name"], x["type"],
                                                        x["mentions"].cast("string")))
    return p.select(
        "id", "corpus", "filename", "page_count",
        F.size("entities").alias("n_entities"),
        F.array_join(ent, ";").alias("entities_text"),
        "redacted_pages", "total_redactions", "total_chars")


@register("list_entities", with_(STAR_MENTIONS, STAR_ENTITIES) + """
SELECT e.id, e.name, e.type, count(*) AS mention_count
FROM star_entities e JOIN star_mentions m ON e.id = m.entity_id
WHERE lower(e.name) LIKE '%red%'
GROUP BY e.id, e.name, e.type ORDER BY mention_count DESC, e.id LIMIT 100""")
def list_entities(spark, sf):
    return X.list_entities(fx.star_entities(spark, sf), fx.star_mentions(spark, sf), q="RED",
                           page=1, limit=100)


@register("list_entities_type", with_(STAR_MENTIONS, STAR_ENTITIES) + """
SELECT e.id, e.name, e.type, count(*) AS mention_count
FROM star_entities e JOIN star_mentions m ON e.id = m.entity_id
WHERE e.type = 'PROMO'
GROUP BY e.id, e.name, e.type ORDER BY mention_count DESC, e.id LIMIT 50 OFFSET 50""")
def list_entities_type(spark, sf):
    return X.list_entities(fx.star_entities(spark, sf), fx.star_mentions(spark, sf), type="PROMO",
                           page=2, limit=50)


@register("get_entity", """
SELECT p_name AS name, arg_min(p_partkey, p_partkey) AS id,
       arg_min(p_type, p_partkey) AS type
FROM part GROUP BY p_name""")
def get_entity(spark, sf):
    """Q9 in bulk: for every name, the row a by-name lookup returns."""
    p = fx.table(spark, sf, "part").select(F.col("p_partkey").alias("id"),
                                           F.col("p_name").alias("name"),
                                           F.col("p_type").alias("type"))
    return X.get_entity(p).select("name", "id", "type")


@register("get_document", with_(STAR_DOCUMENTS) + """
SELECT id, corpus, filename, file_path, is_scanned FROM star_documents
WHERE ok = (SELECT max(o_orderkey) FROM orders)""")
def get_document(spark, sf):
    """Q3: the document of the largest order key, by its id."""
    last = fx.table(spark, sf, "orders").agg(F.max("o_orderkey")).first()[0]
    return X.get_document(fx.star_documents(spark, sf), str(last)).select("id", "corpus", "filename", "file_path", "is_scanned")


@register("entity_appearances", with_(STAR_DOCUMENTS, STAR_MENTIONS) + """
SELECT entity_id, filename, corpus, page_num, context FROM (
  SELECT m.entity_id, d.filename, d.corpus, m.page_num, m.context,
         row_number() OVER (PARTITION BY m.entity_id
                            ORDER BY d.corpus, d.filename, m.page_num, m.context) AS rn
  FROM star_mentions m JOIN star_documents d ON m.doc_id = d.id) WHERE rn <= 50""")
def entity_appearances(spark, sf):
    return X.entity_appearances(fx.star_mentions(spark, sf), fx.star_documents(spark, sf))


@register("entity_cooccurrence", with_(STAR_SUPPLIER_MENTIONS) + """,
focus AS (SELECT entity_id FROM supp_mentions GROUP BY entity_id
          ORDER BY count(*) DESC, entity_id LIMIT 1)
SELECT * FROM (
  SELECT f.entity_id AS focus_id, s.s_name AS name, 'ORG' AS type,
         count(*) AS mention_pairs, count(DISTINCT m1.doc_id) AS shared_docs,
         row_number() OVER (PARTITION BY f.entity_id ORDER BY count(*) DESC, s.s_name) AS rn
  FROM focus f
  JOIN supp_mentions m1 ON m1.entity_id = f.entity_id
  JOIN supp_mentions m2 ON m1.doc_id = m2.doc_id AND m2.entity_id <> f.entity_id
  JOIN supplier s ON s.s_suppkey = m2.entity_id
  GROUP BY f.entity_id, s.s_name) WHERE rn <= 20""".replace("SELECT * FROM (", "SELECT focus_id, name, type, mention_pairs, shared_docs FROM ("))
def entity_cooccurrence(spark, sf):
    """Q11 for the most-mentioned supplier; the raw mention self join in SQL
    is the oracle for the pre-aggregated plan."""
    m = fx.star_supplier_mentions(spark, sf)
    return X.entity_cooccurrence(m, fx.star_supplier_entities(spark, sf), X.most_mentioned(m))


_TIMELINE_SQL = with_(STAR_DOCUMENTS, STAR_MENTIONS, STAR_ENTITIES) + """
SELECT m.context, m.page_num, d.filename, d.corpus, e.name AS entity_name, e.type AS entity_type
FROM star_mentions m JOIN star_documents d ON m.doc_id = d.id JOIN star_entities e ON m.entity_id = e.id
WHERE e.type = 'ECONOMY' {extra}
ORDER BY d.corpus, d.filename, m.page_num, e.name, m.context {limit}"""


@register("timeline", _TIMELINE_SQL.format(extra="", limit=""))
def timeline(spark, sf):
    """Q12 with type ECONOMY standing for DATE, the whole timeline."""
    return X.timeline(fx.star_mentions(spark, sf), fx.star_documents(spark, sf),
                      fx.star_entities(spark, sf), date_type="ECONOMY", limit=None)


@register("timeline_page", _TIMELINE_SQL.format(
    extra="AND d.corpus = '2-HIGH' AND lower(e.name) LIKE '%red%'", limit="LIMIT 200 OFFSET 200"))
def timeline_page(spark, sf):
    return X.timeline(fx.star_mentions(spark, sf), fx.star_documents(spark, sf),
                      fx.star_entities(spark, sf), corpus="2-HIGH", entity="red",
                      date_type="ECONOMY", page=2, limit=200)


@register("redaction_totals", with_(STAR_DOCUMENTS, STAR_REDACTIONS) + """
SELECT CAST(coalesce(sum(r.redaction_count), 0) AS BIGINT) AS total_redactions,
       CAST(coalesce(sum(r.estimated_chars), 0) AS BIGINT) AS total_chars_redacted
FROM star_redactions r JOIN star_documents d ON r.doc_id = d.id""")
def redaction_totals(spark, sf):
    return X.redaction_totals(fx.star_redactions(spark, sf), fx.star_documents(spark, sf))


@register("redactions_by_corpus", with_(STAR_DOCUMENTS, STAR_REDACTIONS) + """
SELECT d.corpus, count(DISTINCT d.id) AS docs_with_redactions,
       CAST(sum(r.redaction_count) AS BIGINT) AS total_redactions
FROM star_redactions r JOIN star_documents d ON r.doc_id = d.id GROUP BY d.corpus""")
def redactions_by_corpus(spark, sf):
    return X.redactions_by_corpus(fx.star_redactions(spark, sf), fx.star_documents(spark, sf))


@register("most_redacted", with_(STAR_DOCUMENTS, STAR_REDACTIONS) + """
SELECT d.filename, d.corpus, CAST(sum(r.redaction_count) AS BIGINT) AS total_redactions
FROM star_redactions r JOIN star_documents d ON r.doc_id = d.id
GROUP BY d.id, d.filename, d.corpus ORDER BY total_redactions DESC, d.id LIMIT 10""")
def most_redacted(spark, sf):
    return X.most_redacted(fx.star_redactions(spark, sf), fx.star_documents(spark, sf))


@register("release_log", with_(STAR_DOCUMENTS, STAR_MENTIONS, STAR_RELEASES) + """
SELECT id, corpus, run_date, docs_added, entities_found, notes FROM star_releases""")
def release_log_q(spark, sf):
    return release_log(fx.star_documents(spark, sf), fx.star_mentions(spark, sf))


@register("changelog", with_(STAR_DOCUMENTS, STAR_MENTIONS, STAR_RELEASES) + """
SELECT id, corpus, run_date, docs_added, entities_found, notes FROM star_releases
ORDER BY run_date DESC, id DESC LIMIT 100""")
def changelog(spark, sf):
    return X.changelog(fx.star_releases(spark, sf), limit=100)


@register("changelog_feed", with_(STAR_DOCUMENTS, STAR_MENTIONS, STAR_RELEASES) + """
SELECT upper(corpus) || ' - ' || docs_added || ' docs added' AS title, notes AS description,
       run_date AS "pubDate"
FROM star_releases ORDER BY run_date DESC, id DESC LIMIT 20""")
def changelog_feed(spark, sf):
    return X.changelog_feed(fx.star_releases(spark, sf))
