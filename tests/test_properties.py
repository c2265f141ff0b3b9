"""Property tests: random inputs against independent oracles (SQLite's own
LIKE, Python's str.split / re.finditer). One Spark job per generated batch."""

import math
import sqlite3

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions.text import name_contains
from quarry.operators import chunks as C
from quarry.operators import mentions as M

from test_text_ops import py_chunks, py_mentions

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
ALPHABET = st.sampled_from(list("aAbBéÉ%_\\ 'z1"))
WS = st.sampled_from([" ", "  ", "\n", "\t", " ", " ", " \r\n"])


@SETTINGS
@given(names=st.lists(st.text(ALPHABET, max_size=8), min_size=1, max_size=30),
       q=st.text(ALPHABET, min_size=1, max_size=3))
def test_like_equals_sqlite(spark, names, q):
    con = sqlite3.connect(":memory:")
    expected = [n for n in names if con.execute("SELECT ? LIKE ?", (n, f"%{q}%")).fetchone()[0]]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, name string")
    got = [r.name for r in df.filter(name_contains(F.col("name"), q)).orderBy("i").collect()]
    assert got == expected


@SETTINGS
@given(pages=st.lists(st.tuples(st.integers(0, 700), st.lists(WS, min_size=1, max_size=3)),
                      min_size=1, max_size=6))
def test_chunks_cover_all_words(spark, pages):
    rows = []
    for i, (n, seps) in enumerate(pages):
        text = "".join(f"w{j}" + seps[j % len(seps)] for j in range(n))
        rows.append((f"d{i}", 1, seps[0] + text))
    df = spark.createDataFrame(rows, "doc_id string, page_num int, text string")
    got = {}
    for r in C.chunk_text(df).orderBy("doc_id", "chunk_idx").collect():
        got.setdefault(r.doc_id, []).append(r.text)
    for doc, _, text in rows:
        exp = py_chunks(text.strip())
        assert got.get(doc, []) == exp
        n = len(text.split())
        assert len(exp) == math.ceil(n / 250)
        assert set(" ".join(exp).split()) == set(text.split())


WORDS = st.sampled_from(["Alpha", "beta", "Gamma", "10.0.0.1", "Licensed under X", "Ab", "Zz",
                         "mail@ex.com", "Delta", "\n", "  ", "1999-12-31", "Éclair"])


@SETTINGS
@given(texts=st.lists(st.lists(WORDS, max_size=40).map(" ".join), min_size=1, max_size=5))
def test_mentions_equal_finditer(spark, texts):
    rows = [(f"d{i}", 1, t) for i, t in enumerate(texts)]
    pages = spark.createDataFrame(rows, "doc_id string, page_num int, text string")
    got = sorted((r.doc_id, r.type, r.name, r.start, r.context) for r in M.extract_mentions(pages).collect())
    exp = sorted((f"d{i}",) + m for i, t in enumerate(texts)
                 for m in py_mentions(t, M.DEFAULT_PATTERNS, M.S.ENTITY_TYPES))
    assert got == exp
