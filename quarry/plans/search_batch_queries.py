"""Registered bulk search (X4) and its SQL twin."""

from __future__ import annotations

from quarry.operators import search as X
from quarry.operators import search_batch as B
from quarry.plans.search_queries import _HEAD, _index, _pages_with
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


def _joined(where: str, *aliases: str) -> str:
    """Pages with occurrences (one per alias) in one column, under a condition."""
    a, *others = aliases
    tables = "".join(f" JOIN occ {o} ON {o}.doc_id = {a}.doc_id AND {o}.page_num = {a}.page_num AND {o}.col = {a}.col" for o in others)
    return f"SELECT DISTINCT {a}.doc_id, {a}.page_num FROM occ {a}{tables} WHERE {where}"


# query id: (expression, corpus, the pages in SQL); all kinds of leaves and operators
CASES = {
    "term": (X.Term("and"), None, _pages_with("term = 'and'")),
    "in corpus": (X.Term("and"), "src1", _pages_with("term = 'and'")),
    "all": (X.Term("the on"), None, _pages_with("term = 'the'") + " INTERSECT " + _pages_with("term = 'on'")),
    "any": (X.Term("und") | X.Term("les"), None, _pages_with("term IN ('und', 'les')")),
    "not": (X.Term("the") - X.Term("on"), None, _pages_with("term = 'the'") + " EXCEPT " + _pages_with("term = 'on'")),
    "phrase": (X.Phrase("the on"), None, _joined("a.term = 'the' AND b.term = 'on' AND b.pos = a.pos + 1", "a", "b")),
    "prefix": (X.Prefix("tha"), None, _pages_with("starts_with(term, 'tha')")),
    "phrase prefix": (X.Prefix("the o"), None, _joined("a.term = 'the' AND starts_with(b.term, 'o') AND b.pos = a.pos + 1", "a", "b")),
    "near": (X.Near(["the", "and"], 1), None, _joined("a.term = 'the' AND b.term = 'and' AND abs(a.pos - b.pos) - 1 <= 1", "a", "b")),
    "near of three": (X.Near(["the", "of", "and"], 4), None, _joined(
        "a.term = 'the' AND b.term = 'of' AND c.term = 'and' "
        "AND greatest(a.pos, b.pos, c.pos) - least(a.pos, b.pos, c.pos) - 1 <= 4", "a", "b", "c")),
    "near a phrase": (X.Near(["the on", "and"], 2), None, _joined(
        "a.term = 'the' AND x.term = 'on' AND x.pos = a.pos + 1 AND b.term = 'and' "
        "AND ((a.pos <= b.pos AND b.pos - (a.pos + 1) - 1 <= 2) OR (b.pos < a.pos AND a.pos - b.pos - 1 <= 2))", "a", "x", "b")),
    "column": (X.Col("page_num", X.Term("2")), None, _pages_with("col = 'page_num' AND term = '2'")),
    "other columns": (X.Col("page_num", X.Term("2"), exclude=True), None, _pages_with("col <> 'page_num' AND term = '2'")),
    "initial": (X.Col("text", X.Initial("the")), None, _pages_with("col = 'text' AND term = 'the' AND pos = 0")),
    "nested": ((X.Phrase("the on") | X.Prefix("tha")) - (X.Term("und") & X.Col("page_num", X.Term("1"))), None,
               "((" + _joined("a.term = 'the' AND b.term = 'on' AND b.pos = a.pos + 1", "a", "b") + ") UNION ("
               + _pages_with("starts_with(term, 'tha')") + ")) EXCEPT ((" + _pages_with("term = 'und'") + ") INTERSECT ("
               + _pages_with("col = 'page_num' AND term = '1'") + "))"),
    "nothing": (X.Term("nosuchword") & X.Term("the"), None, _pages_with("term = 'nosuchword'")),
}

_HITS = " UNION ALL ".join(
    f"SELECT '{name}' AS query_id, {'NULL' if corpus is None else repr(corpus)} AS wanted, doc_id, page_num FROM ({sql})"
    for name, (_, corpus, sql) in CASES.items())


@register("search_batch", _HEAD + f""",
hits AS ({_HITS})
SELECT h.query_id, d.id, d.corpus, d.filename, d.page_count, h.page_num
FROM hits h JOIN text_documents d ON h.doc_id = d.id WHERE h.wanted IS NULL OR h.wanted = d.corpus""")
def search_batch(spark, sf):
    """X4-X12 for sixteen queries of all kinds in one job over the written index."""
    return B.search_batch(_index(spark, sf), fx.text_documents(spark, sf), [(name, e, corpus) for name, (e, corpus, _) in CASES.items()])
