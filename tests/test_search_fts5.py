"""Stemmed search (the reference's 'porter ascii' index) against SQLite FTS5."""

import re
import sqlite3

import pytest

from quarry.functions.porter import stem
from quarry.operators import page_index
from quarry.operators import search as X
from quarry.sources import fixtures as fx

from conftest import SF001

EDGE = [
    ("e1", 1, "a b c d e f g"),
    ("e2", 1, "Étude ÉTUDE étude don't 8f3a-77aa"),
    ("e3", 2, "caresses ponies ties relational hopping running runabout"),
    ("e4", 3, "the quick brown fox 3 jumps"),
    ("e5", 1, "x" * 70 + " generalizations sensibility"),
    ("e6", 1, "a x x a"),
    ("e7", 1, "b x a"),
    ("e8", 1, "a b x x c"), ("e9", 1, "c x a b"), ("e10", 1, "a b c"), ("e11", 1, "x a x b c"),
    ("e12", 1, "c a b"), ("e13", 1, "a b x x x x c d"),
]


@pytest.fixture(scope="module")
def pages(spark):
    p = fx.text_pages(spark, SF001).union(spark.createDataFrame(EDGE, "doc_id string, page_num int, text string"))
    return p.cache()


@pytest.fixture(scope="module")
def fts(pages):
    con = sqlite3.connect(":memory:")
    con.execute("CREATE VIRTUAL TABLE f USING fts5(doc_id, page_num, text, tokenize='porter ascii')")
    rows = [(r.doc_id, r.page_num, r.text) for r in pages.collect() if r.text.strip()]
    con.executemany("INSERT INTO f VALUES (?, ?, ?)", rows)
    return con


def _fts(con, q):
    return {(d, int(p)) for d, p in con.execute("SELECT DISTINCT doc_id, page_num FROM f WHERE f MATCH ?", (q,))}


CASES = [
    ('running', X.Term("running")),
    ('relational', X.Term("relational")),
    ('the on', X.Term("the on")),
    ('the OR und', X.Term("the") | X.Term("und")),
    ('the NOT on', X.Term("the") - X.Term("on")),
    ('"the on"', X.Phrase("the on")),
    ('runn*', X.Prefix("runn")),
    ('thes*', X.Prefix("thes")),
    ('NEAR(a g, 5)', X.Near(["a", "g"], 5)),
    ('NEAR(a g, 4)', X.Near(["a", "g"], 4)),
    ('NEAR(a d g, 5)', X.Near(["a", "d", "g"], 5)),
    ('NEAR(the and, 0)', X.Near(["the", "and"], 0)),
    ('NEAR(a a, 0)', X.Near(["a", "a"], 0)),
    ('NEAR(a a b, 1)', X.Near(["a", "a", "b"], 1)),
    ('- page_num : 2', X.Col("page_num", X.Term("2"), exclude=True)),
    ('- {page_num doc_id} : 2', X.Col(["page_num", "doc_id"], X.Term("2"), exclude=True)),
    ('^"a b"', X.Initial("a b")),
    ('text : ^"a b"', X.Col("text", X.Initial("a b"))),
    ('NEAR("a b" c, 0)', X.Near(["a b", "c"], 0)),
    ('NEAR("a b" c, 1)', X.Near(["a b", "c"], 1)),
    ('NEAR("a b" c, 2)', X.Near(["a b", "c"], 2)),
    ('NEAR(c "a b", 0)', X.Near(["c", "a b"], 0)),
    ('NEAR("a b" "c d", 4)', X.Near(["a b", "c d"], 4)),
    ('NEAR("a b" "c d", 3)', X.Near(["a b", "c d"], 3)),
    ('page_num : 2', X.Col("page_num", X.Term("2"))),
    ('3', X.Term("3")),
    ('^the', X.Initial("the")),
    ('text : ^the', X.Col("text", X.Initial("the"))),
    ('étude', X.Term("étude")),
    ('Étude', X.Term("Étude")),
    ('generalization', X.Term("generalization")),
]


@pytest.fixture(scope="module")
def index(spark, pages, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("postings"))
    X.write_postings(X.build_postings(pages, buckets=4), path)
    X.build_vocabulary(spark.read.parquet(path)).write.parquet(path + "-vocab")
    return X.PostingsIndex(spark.read.parquet(path), 4, stem=True,
                           vocab=spark.read.parquet(path + "-vocab"))


@pytest.mark.parametrize("q,expr", CASES, ids=[c[0] for c in CASES])
@pytest.mark.parametrize("indexed", [False, True])
def test_stemmed_search_equals_fts5(spark, pages, fts, index, q, expr, indexed):
    src = index if indexed else X.PageSource(pages, stem=True)
    got = {(r.doc_id, r.page_num) for r in X.match_pages(src, expr).collect()}
    assert got == _fts(fts, q)


def test_vocabulary_stems_equal_fts5(spark, pages):
    con = sqlite3.connect(":memory:")
    con.execute("CREATE VIRTUAL TABLE f USING fts5(x, tokenize='porter ascii')")
    toks = X.page_tokens(X.index_pages(pages)).select("token").distinct()
    vocab = X.stem_vocabulary(toks).collect()
    con.executemany("INSERT INTO f(rowid, x) VALUES (?, ?)", [(i + 1, r.token) for i, r in enumerate(vocab)])
    con.execute("CREATE VIRTUAL TABLE v USING fts5vocab(f, 'instance')")
    got = dict(con.execute("SELECT doc, term FROM v").fetchall())
    assert all(got[i + 1] == r.term for i, r in enumerate(vocab))


def test_tokenizer_matches_python():
    sep = re.compile(r"[\x00-/:-@\[-`{-\x7f]+")
    assert [t for t in sep.split("don't 8f3a-77aa") if t] == ["don", "t", "8f3a", "77aa"]
    assert stem("a" * 70) == "a" * 70
    assert stem("caresses") == "caress" and stem("ponies") == "poni"


def test_search_pages_joins_documents(spark):
    docs = fx.text_documents(spark, SF001)
    src = X.PageSource(fx.text_pages(spark, SF001), stem=False)
    full = X.search_pages(src, docs, X.Term("and"), limit=None).collect()
    page1 = X.search_pages(src, docs, X.Term("and"), page=1, limit=7).collect()
    page2 = X.search_pages(src, docs, X.Term("and"), page=2, limit=7).collect()
    assert page1 + page2 == full[:14]
    assert set(r.id for r in full) <= {r.id for r in docs.select("id").collect()}


RANK_CASES = [
    ("the", X.Term("the")),
    ("the on", X.Term("the on")),
    ('"the on"', X.Phrase("the on")),
    ("runn*", X.Prefix("runn")),
    ("the OR und", X.Term("the") | X.Term("und")),
    ("the NOT on", X.Term("the") - X.Term("on")),
    ("page_num : 2", X.Col("page_num", X.Term("2"))),
    ('NEAR("a b" c, 2)', X.Near(["a b", "c"], 2)),
    ('^"a b"', X.Initial("a b")),
    ('- page_num : 2', X.Col("page_num", X.Term("2"), exclude=True)),
]


@pytest.mark.parametrize("q,expr", RANK_CASES, ids=[c[0] for c in RANK_CASES])
def test_bm25_equals_fts5(spark, pages, fts, index, q, expr):
    lengths = X.page_lengths(pages)
    got = {(r.doc_id, r.page_num): r.score for r in X.rank_pages(index, expr, lengths).collect()}
    exp = {(d, int(p)): -s for d, p, s in
           fts.execute("SELECT doc_id, page_num, bm25(f) FROM f WHERE f MATCH ?", (q,))}
    assert set(got) == set(exp)
    for k, v in exp.items():
        assert got[k] == pytest.approx(v, rel=1e-9, abs=1e-9), k


def test_bm25_of_near_counts_only_instances_in_the_match(spark):
    rows = [("1", 1, "a b x y z u v"), ("2", 1, "a b x y z a v"), ("3", 1, "q r s t"), ("4", 1, "a a b b a x b"), ("5", 1, "b q")]
    pages = spark.createDataFrame(rows, "doc_id string, page_num int, text string")
    con = sqlite3.connect(":memory:")
    con.execute("CREATE VIRTUAL TABLE f USING fts5(doc_id, page_num, text, tokenize='porter ascii')")
    con.executemany("INSERT INTO f VALUES (?, ?, ?)", rows)
    for q, e in [("NEAR(a b, 1)", X.Near(["a", "b"], 1)), ("NEAR(a b, 0)", X.Near(["a", "b"], 0)),
                 ("NEAR(a x, 3)", X.Near(["a", "x"], 3)), ("NEAR(a b, 1) OR q", X.Near(["a", "b"], 1) | X.Term("q"))]:
        got = {r.doc_id: r.score for r in X.rank_pages(X.PageSource(pages), e, X.page_lengths(pages)).collect()}
        exp = {d: -s for d, s in con.execute("SELECT doc_id, bm25(f) FROM f WHERE f MATCH ?", (q,))}
        assert got == pytest.approx(exp, rel=1e-9, abs=1e-9), q


def _opened(spark, path):
    index = page_index.open_index(spark, path)
    return {"postings": index.postings, "vocabulary": index.vocab.distinct(), "lengths": page_index.read_lengths(spark, path)}


def _same(a, b):
    return a.count() == b.count() and a.exceptAll(b.select(a.columns)).count() == 0


def test_appended_and_merged_segments_equal_one_built_at_once(spark, tmp_path):
    pages = fx.text_pages(spark, SF001)
    parts, whole = str(tmp_path / "parts"), str(tmp_path / "whole")
    for name, part in (("run-1", pages.where("doc_id < '3'")), ("run-2", pages.where("doc_id >= '3'")), ("run-3", pages.limit(0))):
        assert page_index.append_pages(part, parts, 4, name)
        assert not page_index.append_pages(part, parts, 4, name)  # a repeated run adds nothing
    page_index.append_pages(pages, whole, 4)
    expected = _opened(spark, whole)
    for name, table in _opened(spark, parts).items():
        assert _same(table, expected[name]), name
    merged = page_index.compact(spark, parts)
    assert page_index.live_segments(spark, parts) == [merged] and page_index.compact(spark, parts) is None
    assert page_index.drop_replaced(spark, parts) == ["run-1", "run-2", "run-3"]
    assert not page_index.append_pages(pages, parts, 4, "run-1")  # its name stays taken
    for name, table in _opened(spark, parts).items():
        assert _same(table, expected[name]), name
    assert page_index.open_index(spark, parts).vocab.count() == expected["vocabulary"].count()
    with pytest.raises(ValueError):
        page_index.append_pages(pages, parts, 8, "run-4")


def test_a_killed_segment_is_not_seen_and_can_be_repeated(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "index")
    first, second = (spark.createDataFrame([(d, 1, t)], "doc_id string, page_num int, text string") for d, t in (("1", "alpha"), ("2", "alpha beta")))
    page_index.append_pages(first, path, 4, "a")

    def killed(*_):
        raise RuntimeError("killed")

    hits = lambda: sorted(r.doc_id for r in X.match_pages(page_index.open_index(spark, path), X.Term("alpha")).collect())
    with monkeypatch.context() as m:
        m.setattr(page_index, "_commit", killed)
        for _ in range(2):
            with pytest.raises(RuntimeError):
                page_index.append_pages(second, path, 4, "b")
        assert hits() == ["1"]
    page_index.append_pages(second, path, 4, "b")
    with monkeypatch.context() as m:
        m.setattr(page_index, "_commit", killed)
        with pytest.raises(RuntimeError):
            page_index.compact(spark, path)
    assert hits() == ["1", "2"] and page_index.live_segments(spark, path) == ["a", "b"]
    assert page_index.compact(spark, path) and hits() == ["1", "2"]
    assert page_index.read_lengths(spark, path).agg({"n_tokens": "sum"}).first()[0] == 7  # ids, page numbers and texts
    ranked = X.rank_pages(page_index.open_index(spark, path), X.Term("alpha"), page_index.read_lengths(spark, path)).collect()
    assert len(ranked) == 2


def test_an_index_without_segments_finds_nothing(spark, tmp_path):
    index = page_index.open_index(spark, str(tmp_path / "none"))
    assert X.match_pages(index, X.Term("a") | X.Prefix("b")).count() == 0


def test_stemmed_index_prunes_buckets_by_the_vocabulary(index):
    plan = X._occurrences(index, [("run", False)])._jdf.queryExecution().optimizedPlan().toString()
    assert "bucket" in plan and "Join Inner" in plan and "stem" in plan
