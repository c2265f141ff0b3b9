"""Plan properties behind the scale claims (checked on the physical plans)."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from quarry.operators import search as X
from quarry.sources import fixtures as fx

from conftest import SF001

SIDE_EFFECTS = {"stream_ingest", "search_after_stream"}   # runs a stream inside the callable


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(E.queries()) - SIDE_EFFECTS))
def test_no_cartesian_or_nested_loop_join(spark, name):
    p = plan(E.queries()[name](spark, SF001))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("name", ["document_entities", "entity_appearances", "entity_cooccurrence"])
def test_top_k_is_limited_before_the_shuffle(spark, name):
    p = plan(E.queries()[name](spark, SF001))
    assert re.search(r"WindowGroupLimit .*Partial", p) and re.search(r"WindowGroupLimit .*Final", p)


@pytest.mark.parametrize("name", ["extract_mentions", "chunk_text", "page_facts", "tokenize_ascii"])
def test_text_operators_are_narrow(spark, name):
    p = plan(E.queries()[name](spark, SF001))
    kinds = re.findall(r"Exchange \w+\([^)]*\)[^,]*, (\w+)", p)
    # only the skinny-scan spread and the final grouping (tokenize_ascii) shuffle
    assert all(k in ("REPARTITION_BY_NUM", "ENSURE_REQUIREMENTS") for k in kinds)
    if name != "tokenize_ascii":
        assert "ENSURE_REQUIREMENTS" not in p


def test_aggregate_before_join(spark):
    p = plan(E.queries()["redactions_by_corpus"](spark, SF001))
    # the per-document sum sits below the document join
    join_at = min(i for i in (p.find("BroadcastHashJoin"), p.find("SortMergeJoin")) if i >= 0)
    assert "HashAggregate(keys=[doc_id" in p[join_at:]


def test_index_lookup_prunes_and_pushes(spark, tmp_path):
    path = str(tmp_path / "postings")
    X.write_postings(X.build_postings(fx.text_pages(spark, SF001), buckets=8), path)
    idx = X.PostingsIndex(spark.read.parquet(path), 8, stem=False)
    p = plan(X._occurrences(idx, [("and", False)]))
    assert re.search(r"PartitionFilters: \[.*bucket#\d+ = \d+", p)
    assert "EqualTo(term,and)" in p


def test_prefixes_prune_by_the_sorted_vocabulary(spark, tmp_path):
    from quarry.operators import page_index
    path = str(tmp_path / "index")
    page_index.append_pages(fx.text_pages(spark, SF001), path, 8)
    idx = page_index.open_index(spark, path, stem=False)
    p = plan(X._occurrences(idx, [("tha", True)]))
    assert "dynamicpruning" in p and "StringStartsWith(token,tha)" in p
    scan = X.PostingsIndex(idx.postings, 8, stem=False)  # without a vocabulary: every bucket is read
    assert X._occurrences(idx, [("tha", True)]).exceptAll(X._occurrences(scan, [("tha", True)])).count() == 0
    assert X._occurrences(idx, [("tha", True)]).count() == X._occurrences(scan, [("tha", True)]).count() > 0


def test_vector_scan_is_not_shuffled(spark):
    p = plan(E.queries()["vector_topk"](spark, SF001))
    below = p[p.find("MapInPandas"):]
    assert "Exchange" not in below.split("Scan parquet")[0]


def test_cooccurrence_counts_only_the_focus_documents(spark):
    p = plan(E.queries()["entity_cooccurrence"](spark, SF001))
    # every aggregate by (document, entity) has the semi join to the focus below it
    assert p.count("LeftSemi") >= 2


def test_mentions_are_extracted_once_per_load_run(spark):
    from quarry.plans.load_queries import _run
    run = _run(spark, SF001)
    for name in ("status", "mentions", "releases", "totals"):  # the fixture extracts the entities of the earlier run
        assert "MapInArrow" not in plan(run[name]), name


def test_keyset_pages_cover_the_whole(spark):
    from quarry.functions.paging import page_after
    df = spark.createDataFrame([(i % 3, i) for i in range(20)], "a int, b int")
    seen, after = [], None
    while True:
        rows = page_after(df, ["a", "b"], after, 6).collect()
        if not rows:
            break
        seen += rows
        after = tuple(rows[-1])
    assert seen == df.orderBy("a", "b").collect()


def test_keyset_pages_with_mixed_directions_and_nulls(spark):
    from quarry.functions.paging import order_of, page_after
    rows = [(None if i % 5 == 0 else i % 4, None if i % 7 == 0 else f"s{i % 6}", i) for i in range(60)]
    df = spark.createDataFrame(rows, "a int, b string, c int")
    key = [("a", False), "b", ("c", False)]
    seen, after = [], None
    while page := page_after(df, key, after, 7).collect():
        seen += page
        after = tuple(page[-1])
    assert seen == df.orderBy(*order_of(key)).collect()


def test_numbered_pages_read_their_own_parts(spark, tmp_path):
    from quarry.functions.paging import numbered_page, store_order
    df = spark.range(60_000).selectExpr("id % 1000 AS a", "id AS b")
    store_order(df, [("a", False), "b"], str(tmp_path), partitions=20)
    whole = df.orderBy(F.desc("a"), "b").limit(60_000).collect()
    for page, limit in ((1, 6), (10_000, 6), (333, 100), (3, 25_000), (10_001, 6), (7, 0)):
        assert numbered_page(spark, str(tmp_path), page, limit).collect() == whole[(page - 1) * limit:page * limit]
    p = plan(numbered_page(spark, str(tmp_path), 10_000, 6))
    assert re.search(r"PartitionFilters: \[.*_part", p)
    read = spark.read.parquet(f"{tmp_path}/sizes").agg(F.max("n")).first()[0]
    assert read < 0.15 * 60_000
    store_order(df.limit(0), ["a"], str(tmp_path / "none"))
    assert numbered_page(spark, str(tmp_path / "none"), 1, 5).count() == 0


def test_no_local_folder_stands_in_for_the_shared_one():
    from types import SimpleNamespace

    import pytest as pt

    from quarry.session import checkpoint_dir
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pt.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(cluster)
