import hashlib
from collections import defaultdict

from llm_rows import corpus, make_docs  # noqa: F401

from quarry.llm import bloom, line_dedup


def brute(rows):
    fold = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})

    def key(line):
        k = line.strip(" \t\n\x0b\x0c\r").translate(fold)
        return k if len(k) >= 40 else None

    where = defaultdict(set)
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            if key(line) and i is not None:
                where[key(line)].add(i)
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or not (key(x) and len(where[key(x)]) >= 5 and i != max(where[key(x)]))]
        out.append((str(i), len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def test_equals_brute_force(spark, corpus):
    got = line_dedup.line_report(make_docs(spark, corpus)).collect()
    expected = brute(corpus)
    assert sorted((str(r[0]), *r[1:]) for r in got) == expected
    assert sum(r[2] for r in expected) > 20


def test_saturated_filters_change_nothing(spark, corpus):
    docs = make_docs(spark, corpus)
    small = line_dedup.dedup_lines(docs.select("doc_id", "text"), log2_bits=bloom.SEGMENT_LOG2)
    large = line_dedup.dedup_lines(docs.select("doc_id", "text"))
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def test_columns_stay_and_empty_table(spark, corpus):
    docs = make_docs(spark, corpus)
    assert line_dedup.dedup_lines(docs).columns == [*docs.columns, "n_lines", "n_dropped"]
    assert line_dedup.dedup_lines(docs.withColumnRenamed("n", "n_lines")).count() == len(corpus)
    assert line_dedup.line_report(make_docs(spark, [])).count() == 0


def test_cut_lines_keeps_columns_of_any_name(spark, corpus):
    docs = make_docs(spark, corpus).withColumnRenamed("n", "n_lines").withColumnRenamed("key", "__dropped").withColumnRenamed("hash", "dropped")
    docs = docs.withColumnRenamed("size", "row").withColumnRenamed("rep", "a.b")
    cut = line_dedup.cut_lines(docs)
    assert cut.schema.simpleString() == docs.schema.simpleString()
    texts = {str(r.doc_id): r for r in line_dedup.line_report(docs).collect()}
    own = ["doc_id", "lang", "n_lines", "__dropped", "dropped", "row", "`a.b`"]
    assert sorted(map(str, cut.select(own).collect())) == sorted(map(str, docs.select(own).collect()))
    for r in cut.collect():
        if r.text is not None and texts[str(r.doc_id)].n_dropped:
            assert r.n_chars == len(r.text)
    assert line_dedup.cut_lines(docs.limit(0)).count() == 0


def test_twice_filter_has_no_false_negatives(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    twice, once = rng.integers(0, 1 << 63, 500, dtype=np.uint64), rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    values = np.concatenate([twice, once, twice])
    df = spark.createDataFrame([(int(v),) for v in values], "h long").repartition(5)
    bits = bloom.twice_filter(df, lambda b: b.column(0).to_numpy().astype(np.uint64), 22)
    bits = np.frombuffer(bits, np.uint8)
    assert bloom.suspected(twice, bits, 22).all() and bloom.suspected(once, bits, 22).mean() < 0.05
