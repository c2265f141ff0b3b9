"""DuckDB SQL for the fixture views, used by the independent oracle queries.

These are written from the fixture definitions, not generated from the Spark
plans, so that a Spark query and its SQL twin are two separate derivations.
"""

STAR_DOCUMENTS = """
star_documents AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS corpus,
         'order-' || o_orderkey || '.pdf' AS filename,
         '/data/' || o_orderpriority || '/order-' || o_orderkey || '.pdf' AS file_path,
         o_orderdate AS created_at, false AS is_scanned, o_orderkey AS ok
  FROM orders)"""

STAR_PAGE_COUNT = """
star_page_count AS (
  SELECT o.o_orderkey AS ok, CAST(count(l.l_orderkey) AS INTEGER) AS page_count
  FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
  GROUP BY o.o_orderkey)"""

STAR_ENTITIES = """
star_entities AS (
  SELECT p_partkey AS id, p_name || ' #' || p_partkey AS name, p_type AS type FROM part)"""

STAR_MENTIONS = """
star_mentions AS (
  SELECT l_partkey AS entity_id, CAST(l_orderkey AS VARCHAR) AS doc_id,
         l_linenumber AS page_num, l_returnflag || l_linestatus AS context
  FROM lineitem)"""

STAR_SUPPLIER_MENTIONS = """
supp_mentions AS (
  SELECT l_suppkey AS entity_id, CAST(l_orderkey AS VARCHAR) AS doc_id FROM lineitem)"""

STAR_REDACTIONS = """
star_redactions AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS doc_id, l_linenumber AS page_num,
         CAST(count(*) AS INTEGER) AS redaction_count,
         CAST(sum(CAST(trunc((l_quantity / 7) * ((l_discount * 200) / 12)) AS INTEGER)) AS INTEGER)
           AS estimated_chars
  FROM lineitem
  WHERE l_returnflag = 'R' AND l_quantity > 20 AND l_discount * 200 > 8
  GROUP BY l_orderkey, l_linenumber)"""

STAR_SHAPES = """
star_shapes AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS doc_id, l_linenumber AS page_num,
         CASE WHEN l_linestatus = 'O' THEN 'annot' ELSE 'drawing' END AS kind,
         CASE WHEN l_returnflag = 'R' THEN 12 ELSE 4 END AS annot_type,
         CASE WHEN l_returnflag = 'R' THEN [0.0, 0.0, 0.0] ELSE [1.0, 1.0, 1.0] END AS fill,
         l_quantity AS width, l_discount * 200 AS height
  FROM lineitem)"""

STAR_RELEASES = """
star_release_per AS (
  SELECT d.corpus, date_trunc('day', d.created_at) AS run_date,
         CAST(count(*) AS BIGINT) AS docs_added,
         CAST(coalesce(sum(mc.m), 0) AS BIGINT) AS entities_found
  FROM star_documents d
  LEFT JOIN (SELECT doc_id, count(*) AS m FROM star_mentions GROUP BY doc_id) mc ON mc.doc_id = d.id
  GROUP BY d.corpus, date_trunc('day', d.created_at)),
star_releases AS (
  SELECT CAST(epoch(run_date) AS BIGINT) * 1000
           + row_number() OVER (PARTITION BY run_date ORDER BY corpus) AS id,
         corpus, run_date, docs_added, entities_found,
         'Ingestion run ' || strftime(run_date, '%Y-%m-%d %H:%M') AS notes
  FROM star_release_per)"""

# TEXT fixture --------------------------------------------------------------

# Python's whitespace set, as characters for trim() and as a regex class.
PY_WS_CHARS = ("chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30)"
               " || chr(31) || chr(32) || chr(133) || chr(160) || chr(5760) || chr(8192) || chr(8193)"
               " || chr(8194) || chr(8195) || chr(8196) || chr(8197) || chr(8198) || chr(8199)"
               " || chr(8200) || chr(8201) || chr(8202) || chr(8232) || chr(8233) || chr(8239)"
               " || chr(8287) || chr(12288)")
PY_WS_CLASS = ("[\\t\\n\\x{0B}\\f\\r\\x{1C}-\\x{1F} \\x{85}\\x{A0}\\x{1680}"
               "\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]")

TEXT_DOCUMENTS = """
text_documents AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, source AS corpus, 'doc-' || doc_id || '.pdf' AS filename,
         '/data/' || source || '/doc-' || doc_id || '.pdf' AS file_path,
         CAST(ceil(length(text) / 2000) AS INTEGER) AS page_count,
         TIMESTAMP '2025-03-18 09:30:00' AS created_at
  FROM documents)"""

TEXT_PAGES = """
text_pages AS (
  SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(i + 1 AS INTEGER) AS page_num,
         substring(text, i * 2000 + 1, 2000) AS text
  FROM (SELECT doc_id, text,
               unnest(range(0, CAST(greatest(ceil(length(text) / 2000), 1) AS BIGINT))) AS i
        FROM documents))"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"
