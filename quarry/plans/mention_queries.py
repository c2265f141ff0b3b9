"""Registered dictionary mentions (M1) and their SQL twin."""

from __future__ import annotations

from quarry.operators import gazetteer as G
from quarry.plans.oracle import TEXT_PAGES, with_
from quarry.plans.text_queries import _STRIPPED, _trim
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


_WORD = "[0-9A-Za-z\\x{80}-\\x{10FFFF}]+"
_BETWEEN = "[^0-9A-Za-z\\x{80}-\\x{10FFFF}]*"

_NAMES = f"""
listed AS (
  SELECT array_to_string(w[1:1], ' ') AS name, 'GPE' AS type FROM (SELECT string_split(text, ' ') AS w FROM benchmark)
  UNION SELECT array_to_string(w[1:2], ' '), unnest(['PERSON']) FROM (SELECT string_split(text, ' ') AS w FROM benchmark)
  UNION SELECT array_to_string(w[2:3], ' '), unnest(['PERSON', 'ORG']) FROM (SELECT string_split(text, ' ') AS w FROM benchmark)
  UNION SELECT array_to_string(w[1:3], ' '), unnest(['ORG']) FROM (SELECT string_split(text, ' ') AS w FROM benchmark)
  UNION SELECT array_to_string(w[3:6], ' '), unnest(['EVENT']) FROM (SELECT string_split(text, ' ') AS w FROM benchmark)),
names AS (
  SELECT name, type, regexp_extract_all(name, '{_WORD}') AS w, length(regexp_extract(name, '^{_BETWEEN}')) AS lead,
         length(regexp_extract(name, '{_BETWEEN}$')) AS trail
  FROM listed WHERE length(name) >= 2)"""

# every run of words as long as a name that begins with a name's first word; then from each page's first
# match to the next one that begins behind it
_MATCHED = f"""
split AS (SELECT doc_id, page_num, t, regexp_extract_all(t, '{_WORD}') AS w, string_split_regex(t, '{_WORD}') AS s FROM stripped WHERE t <> ''),
numbered AS (SELECT doc_id, page_num, t, w, s, unnest(range(1, len(w) + 1)) AS i FROM split),
placed AS (
  SELECT doc_id, page_num, i, w[i] AS word, length(s[i]) + length(w[i]) AS step, length(w[i]) AS size FROM numbered),
words AS (
  SELECT doc_id, page_num, i, word,
         (sum(step) OVER (PARTITION BY doc_id, page_num ORDER BY i))::BIGINT AS stop, size FROM placed),
candidates AS (
  SELECT a.doc_id, a.page_num, a.stop - a.size - n.lead AS start, b.stop + n.trail AS stop, len(n.w) AS n_words, n.name, n.type
  FROM words a JOIN names n ON a.word = n.w[1]
  JOIN words b ON b.doc_id = a.doc_id AND b.page_num = a.page_num AND b.i = a.i + len(n.w) - 1),
fitting AS (
  SELECT c.*, p.t FROM candidates c JOIN stripped p USING (doc_id, page_num)
  WHERE c.start >= 0 AND regexp_replace(substring(p.t, c.start + 1, c.stop - c.start), '\\s+', ' ', 'g') = c.name),
longest AS (
  SELECT doc_id, page_num, start, arg_max(stop, n_words * 1000000 + stop - start) AS stop FROM fitting GROUP BY ALL),
linked AS (
  SELECT a.doc_id, a.page_num, a.start, a.stop, b.start AS next
  FROM longest a ASOF LEFT JOIN longest b ON a.doc_id = b.doc_id AND a.page_num = b.page_num AND a.stop <= b.start),
kept(doc_id, page_num, start, stop, next) AS (
  SELECT doc_id, page_num, min(start), arg_min(stop, start), arg_min(coalesce(next, -1), start) FROM linked GROUP BY ALL
  UNION ALL
  SELECT l.doc_id, l.page_num, l.start, l.stop, coalesce(l.next, -1)
  FROM kept k JOIN linked l ON l.doc_id = k.doc_id AND l.page_num = k.page_num AND l.start = k.next)"""

_CONTEXT = _trim("replace(substring(f.t, greatest(0, f.start - 60) + 1, least(length(f.t), f.stop + 60) - greatest(0, f.start - 60)), chr(10), ' ')")


@register("extract_mentions_gazetteer", with_(TEXT_PAGES, _STRIPPED, _NAMES, _MATCHED).replace("WITH ", "WITH RECURSIVE ", 1) + f"""
SELECT DISTINCT f.doc_id, f.page_num, f.type, f.name, f.start::INTEGER AS start, {_CONTEXT} AS context
FROM kept k JOIN fitting f ON f.doc_id = k.doc_id AND f.page_num = k.page_num AND f.start = k.start AND f.stop = k.stop""")
def extract_mentions_gazetteer(spark, sf):
    """M1 by dictionary: every page against the names that benchmark passages begin with."""
    return (G.extract_mentions_gazetteer(fx.text_pages(spark, sf), fx.benchmark_names(spark, sf))
            .select("doc_id", "page_num", "type", "name", "start", "context"))
