"""Steps whose memory, shuffle or time must grow no faster than their input: what they deal out, and that the results stay."""

import collections
import re

import __spark_entry__ as E
import pytest
from pyspark.sql import functions as F

from quarry.operators import explore, page_index
from quarry.operators import search as X
from quarry.operators import search_batch as B
from quarry.streaming import ingest

PAGES = "doc_id string, page_num int, text string"
ROWS = [("a-1", 1, "The étude, the THE on"), ("a-1", 2, "the on"), ("b", 1, None), ("b", 2, "  "), (None, 1, "the end"), ("c", None, "on the"),
        ("d", 1, "the x"), ("d", 1, "y the the"), ("e", 1, "x" * 300 + " Ünd the")]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _tokens(v):
    return [t for t in re.split(r"[\x00-/:-@\[-`{-\x7f]+", "".join(c.lower() if c.isascii() else c for c in v)) if t]


def _occurrences(rows):
    return [(t, d, p, col, i) for d, p, text in rows if text and text.strip()
            for col, v in (("doc_id", d), ("page_num", p), ("text", text)) if v is not None for i, t in enumerate(_tokens(str(v)))]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(ROWS, PAGES).repartition(2)


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    """A folder with a documents table of these rows, one document twice and one null id."""
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, f"the text {i} on " * 400, "en", f"src{i % 3}") for i in range(20)] + [(3, "The other on", "en", "src0"), (None, "the lost", "en", "src1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1,), (2,)], "doc_id long").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.mark.parametrize("lists", [None, "page", "pages"])
def test_postings_of_every_form_hold_every_occurrence(pages, lists):
    p = X.build_postings(pages, 4, lists)
    assert "Exchange" not in _plan(p).split("MapInArrow")[0]
    if lists == "pages":
        p = X.posting_rows(p)
    elif lists == "page":
        p = p.withColumn("pos", F.explode("pos"))
    got = collections.Counter((r.term, r.doc_id, r.page_num, r.col, r.pos) for r in p.collect())
    assert got == collections.Counter(_occurrences(ROWS))
    assert p.where(F.col("bucket") != X.term_bucket(F.col("term"), 4)).count() == 0


def test_slices_of_a_batch_hold_every_page(pages, monkeypatch):
    from quarry.functions import postings
    monkeypatch.setattr(postings, "SLICE", 8)
    import pyarrow as pa
    rows = [r for r in ROWS if r[2]]
    batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in ((0, pa.string()), (1, pa.int32()), (2, pa.string()))], ["doc_id", "page_num", "_v_text"])
    out = [r for b in postings.of_pages(["doc_id", "page_num"], ["text"], False)([batch]) for r in b.to_pylist()]
    got = collections.Counter((r["term"], d, p, i) for r in out for d, p, i in zip(r["doc_id"], r["page_num"], r["pos"], strict=True))
    assert got == collections.Counter((t, d, p, i) for t, d, p, col, i in _occurrences(rows) if col == "text")
    assert len(out) > len({r["term"] for r in out})


@pytest.mark.parametrize("name", ["tokenize_ascii", "build_postings"])
def test_page_counts_are_made_in_the_page_row(spark, documents, name):
    """only pages whose key comes twice are dealt out by their tokens."""
    df = E.queries()[name](spark, documents)
    got = [tuple(r) for r in df.collect()]
    texts = collections.defaultdict(list)
    for r in spark.read.parquet(f"{documents}/documents.parquet").collect():
        for i in range(0, len(r.text), 2000):
            texts[r.doc_id, i // 2000 + 1].append(r.text[i:i + 2000])
    occ = [((None if d is None else str(d)), p, col, t, i) for (d, p), several in texts.items() for text in several
           for col, v in (("doc_id", d), ("page_num", p), ("text", text)) if v is not None for i, t in enumerate(_tokens(str(v)))]
    groups = collections.defaultdict(list)
    for d, p, col, t, i in occ:
        groups[(d, p, col) if name == "tokenize_ascii" else (t, d, p, col)].append(t if name == "tokenize_ascii" else i)
    if name == "tokenize_ascii":
        assert collections.Counter(got) == collections.Counter((*k, len(v), len(set(v))) for k, v in groups.items())
    else:
        assert collections.Counter(got) == collections.Counter((*k, ",".join(map(str, sorted(v)))) for k, v in groups.items())
    first = df._jdf.queryExecution().optimizedPlan().toString().split("Union")[1]
    assert "Aggregate" not in first[:first.index("LeftAnti")]


def test_an_index_is_written_in_lists_without_a_shuffle_and_joined_before_it_is_unfolded(spark, pages, tmp_path):
    """A row per term and slice of pages, not per occurrence."""
    page_index.append_pages(pages, str(tmp_path / "index"), 4, "one")
    rows = spark.read.parquet(str(tmp_path / "index/postings/segment=one"))
    assert rows.count() < X.build_postings(pages, 4).count() and "array" in rows.schema["pos"].dataType.simpleString()
    index = page_index.open_index(spark, str(tmp_path / "index"), stem=True)
    assert collections.Counter(tuple(r) for r in index.postings.select("term", "doc_id", "page_num", "col", "pos").collect()) == collections.Counter(_occurrences(ROWS))
    found = X._occurrences(index, [("the", False)])
    p = found._jdf.queryExecution().optimizedPlan().toString()
    assert p.index("Generate") < p.index("Join")  # the join is below
    assert found.count() == sum(t == "the" for t, *_ in _occurrences(ROWS))
    assert "BroadcastHashJoin" in _plan(found)  # the words' size is known: the postings stay where they are
    n = {(r.doc_id, r.page_num, r.n_tokens) for r in page_index.read_lengths(spark, str(tmp_path / "index")).where("doc_id IN ('a-1', 'e')").collect()}
    assert n == {("a-1", 1, 8), ("a-1", 2, 5), ("e", 1, 5)}


def test_votes_meet_by_page_before_they_are_counted(spark, pages, tmp_path, monkeypatch):
    """a task's table of votes holds its pages', not its input split's."""
    page_index.append_pages(pages, str(tmp_path / "index"), 4)
    index = page_index.open_index(spark, str(tmp_path / "index"), stem=False)
    monkeypatch.setattr(B, "VOTES", 1)
    hits = B.match_batch(index, [("p", X.Phrase("the on"), None), ("t", X.Term("end"), None)])
    assert {(r.query_id, r.doc_id, r.page_num) for r in hits.collect()} == {("p", "a-1", 1), ("p", "a-1", 2), ("t", None, 1)}
    p = hits._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [doc_id" in p
    assert all("Exchange" in part for part in re.findall(r"HashAggregate\(keys=\[doc_id[^\n]*partial_count(.*?)FileScan", _plan(hits), re.S))


def test_pairs_are_counted_where_they_meet(spark):
    """no table of a split's pairs before the shuffle."""
    m = spark.createDataFrame([("d", e, 1) for e in (1, 1, 2)] + [(None, 1, 1), ("f", None, 1)], "doc_id string, entity_id long, page_num int")
    e = spark.createDataFrame([(1, "one", "T"), (2, "two", "T")], "id long, name string, type string")
    df = explore.document_entities(m, e)
    assert {tuple(r) for r in df.collect()} == {("d", "one", "T", 2), ("d", "two", "T", 1), (None, "one", "T", 1)}
    p = _plan(explore.document_entities(m, e))
    assert "REPARTITION" in p and "HashAggregate" not in p[p.index("REPARTITION"):]


def test_a_batch_without_repeats_is_not_joined(spark, tmp_path):
    """the outputs of a batch read it as it is."""
    rows = [(d, "c", f"{d}.pdf", f"/{d}", [(1, t)]) for d, t in (("1", "short"), ("2", "one"), ("2", "longer"), (None, "n"), (None, "n"))]
    for name, some, n in (("repeats", rows, 3), ("none", rows[:2], 2)):
        spark.createDataFrame(some, ingest.RAW_INPUT).repartition(2).write.parquet(str(tmp_path / name))
        once = ingest.each_document_once(spark.read.parquet(str(tmp_path / name)))
        assert "Join" not in once._jdf.queryExecution().optimizedPlan().toString()
        got = {r.doc_id: r.pages[0].text for r in once.collect()}
        assert once.count() == len(got) == n and got["1"] == "short"
        assert got["2"] == ("longer" if name == "repeats" else "one")


def test_nested_pages_are_shuffled_once(spark):
    """the attributes come to the records' partitions; pages without a number stay."""
    from quarry.operators import pages as P
    rows = [("1", p, f"t{p}", 0, 0, 1) for p in (1, 2, 3, None)] + [("2", 1, "u", 0, 0, 1), ("3", 1, "v", 0, 0, 1)]
    pages = spark.createDataFrame(rows, "doc_id string, page_num int, text string, redaction_count int, estimated_chars_redacted int, word_count int")
    docs = spark.createDataFrame([(d, "c", f"{d}.pdf", f"/{d}") for d in "122"], "id string, corpus string, filename string, file_path string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = P.nest_pages(pages, docs, 2)
        got = sorted((r.doc_id, -1 if r.block is None else r.block, r.page_count, r.filename, [p.text for p in r.pages]) for r in out.collect())
        plan = _plan(out).split("Initial Plan")[-1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == [("1", -1, 4, "1.pdf", ["tNone"]), ("1", 0, 4, "1.pdf", ["t1", "t2"]), ("1", 1, 4, "1.pdf", ["t3"]), *[("2", 0, 1, "2.pdf", ["u"])] * 2]
    assert not re.search(r"Exchange hashpartitioning\(doc_id[^\n]*\n[^\n]*(Project[^\n]*\n[^\n]*|Filter[^\n]*\n[^\n]*)*ObjectHashAggregate\(keys=\[doc_id[^\n]*functions=\[collect_list", plan)
    assert plan.count("collect_list") - plan.count("partial_collect_list") >= 1 and "SortMergeJoin [doc_id" in plan


def test_an_index_of_many_buckets_is_not_many_small_files(spark, pages, tmp_path):
    import pathlib
    page_index.append_pages(pages.repartition(4), str(tmp_path / "index"), 100)
    files = collections.Counter(f.parent.name for f in pathlib.Path(tmp_path / "index/postings/segment=segment").parent.rglob("*.parquet"))
    assert max(files.values()) == 1
    index = page_index.open_index(spark, str(tmp_path / "index"), stem=False)
    assert X._occurrences(index, [("the", False)]).count() == sum(t == "the" for t, *_ in _occurrences(ROWS))
