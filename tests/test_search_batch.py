"""Bulk search: equal to one search per query, by one plan whatever their number."""

import random
import tempfile

import pytest

from quarry.operators import page_index
from quarry.operators import search as X
from quarry.operators import search_batch as B

WORDS = ["alpha", "beta", "betas", "gamma", "alphabet", "of", "the"]


@pytest.fixture(scope="module")
def store(spark):
    rng = random.Random(8)
    pages = [(str(d), p, " ".join(rng.choices(WORDS, k=rng.randrange(0, 14)))) for d in range(25) for p in (1, 2)]
    df = spark.createDataFrame([*pages, ("x", 1, None)], "doc_id string, page_num int, text string")
    docs = spark.createDataFrame([(str(d), f"c{d % 3}", f"{d}.pdf", 2) for d in range(25)], "id string, corpus string, filename string, page_count int")
    folder = tempfile.mkdtemp(prefix="quarry-batch-") + "/index"
    page_index.append_pages(df, folder, 4)
    return folder, docs


def _random_query(rng, depth=0):
    some = lambda n: " ".join(rng.choices(WORDS, k=n))
    kind = rng.randrange(6 if depth > 2 else 10)
    if kind == 0:
        return X.Term(some(rng.choice([1, 1, 2])))
    if kind == 1:
        return X.Phrase(some(rng.choice([1, 2, 2, 3])))
    if kind == 2:
        return X.Prefix(rng.choice(["al", "b", "beta", "the be", "of a"]))
    if kind == 3:
        return X.Near([some(1), some(rng.choice([1, 1, 2])), *([some(1)] if rng.random() < 0.3 else [])], rng.randrange(0, 4))
    if kind == 4:
        return X.Initial(some(rng.choice([1, 2])))
    if kind == 5:
        return X.Col(rng.choice(["text", "doc_id", "page_num"]), X.Term(rng.choice([*WORDS, "1", "7"])), exclude=rng.random() < 0.3)
    a, b = _random_query(rng, depth + 1), _random_query(rng, depth + 1)
    return {6: a & b, 7: a | b, 8: a - b, 9: X.Col(["text", "page_num"], a)}[kind]


def _described(e):
    return repr(e)


@pytest.mark.parametrize("stem", [False, True])
def test_equals_single_searches(spark, store, stem):
    folder, docs = store
    index = page_index.open_index(spark, folder, stem)
    rng = random.Random(int(stem))
    queries = [(f"q{i}", _random_query(rng), "c1" if i % 5 == 0 else None) for i in range(18)]
    got: dict = {}
    for r in B.search_batch(index, docs, queries).collect():
        got.setdefault(r.query_id, []).append((r.id, r.page_num))
    for query_id, e, corpus in queries:
        one = [(r.id, r.page_num) for r in X.search_pages(index, docs, e, corpus=corpus, limit=None).collect()]
        assert sorted(got.get(query_id, [])) == sorted(one), _described(e)


def test_pages_of_each_result(spark, store):
    folder, docs = store
    index = page_index.open_index(spark, folder, False)
    queries = [("a", X.Term("alpha")), ("b", X.Term("beta")), ("none", X.Term("zzz"))]
    whole = sorted((r.query_id, r.id, r.page_num) for r in B.search_batch(index, docs, queries).collect())
    second = sorted((r.query_id, r.id, r.page_num) for r in B.search_batch(index, docs, queries, page=2, limit=5).collect())
    assert second == [x for q in "ab" for x in [w for w in whole if w[0] == q][5:10]]
    assert B.search_batch(index, docs, []).count() == 0
    with pytest.raises(ValueError):
        B.search_batch(index, docs, [("a", X.Term("x")), ("a", X.Term("y"))])


def test_one_plan_whatever_the_number_of_queries(spark, store):
    folder, docs = store
    index = page_index.open_index(spark, folder, False)
    size = lambda n: len(B.search_batch(index, docs, [(i, X.Phrase("alpha beta") - X.Near(["of", "the"], 2)) for i in range(n)])
                         ._jdf.queryExecution().optimizedPlan().toString().splitlines())
    assert size(2) == size(60)
