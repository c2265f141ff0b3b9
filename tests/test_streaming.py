"""Incremental ingest with Structured Streaming, run twice."""

from pyspark.sql import functions as F

from quarry.sources import fixtures as fx
from quarry.streaming.ingest import raw_input_from_pages, read_store, stream_ingest

from conftest import SF001


def _raw(spark):
    files = fx.text_documents(spark, SF001).select(F.col("id").alias("doc_id"), "corpus", "filename",
                                                   "file_path")
    return raw_input_from_pages(fx.text_pages(spark, SF001), files)


def test_stream_ingest_adds_only_unseen(spark, tmpdir_fresh):
    src, store, ckpt = f"{tmpdir_fresh}/src", f"{tmpdir_fresh}/store", f"{tmpdir_fresh}/ckpt"
    raw = _raw(spark).cache()
    corpora = sorted(r[0] for r in raw.select("corpus").distinct().collect())
    first = raw.filter(F.col("corpus").isin(corpora[: len(corpora) // 2]))
    first.write.mode("append").parquet(src)
    # the same files again in a second input file: repeated file names
    first.limit(5).write.mode("append").parquet(src)
    stream_ingest(spark, src, store, checkpoint=ckpt).awaitTermination()
    docs1 = read_store(spark, store, "documents")
    n1 = docs1.count()
    assert n1 == docs1.select("filename").distinct().count()
    expected1 = raw.filter(F.col("corpus").isin(corpora[: len(corpora) // 2]))
    # text-based files only (first page > 50 characters)
    assert n1 <= expected1.count() and n1 > 0

    # second run: the rest plus copies of already loaded files
    raw.filter(~F.col("corpus").isin(corpora[: len(corpora) // 2])).write.mode("append").parquet(src)
    first.limit(7).write.mode("append").parquet(src)
    stream_ingest(spark, src, store, checkpoint=ckpt).awaitTermination()
    docs2 = read_store(spark, store, "documents")
    assert docs2.count() == docs2.select("filename").distinct().count()
    assert docs2.count() > n1
    rel = read_store(spark, store, "releases")
    assert rel.select("batch_id").distinct().count() == 2
    # every batch logs one row per corpus of its input
    assert rel.filter("docs_added > 0").agg(F.sum("docs_added")).first()[0] == docs2.count()
    # mentions point at loaded documents and known entities only
    m = read_store(spark, store, "mentions")
    e = read_store(spark, store, "entities")
    assert m.join(docs2, m.doc_id == docs2.id, "left_anti").count() == 0
    assert m.join(e, m.entity_id == e.id, "left_anti").count() == 0
    assert e.groupBy("name", "type").count().filter("count > 1").count() == 0


def _drop(spark, src, rows):
    raw = [(i, "alpha", f"{i}.pdf", f"/a/{i}.pdf", [(1, t)]) for i, t in rows]
    spark.createDataFrame(raw, "doc_id string, corpus string, filename string, file_path string, "
                               "pages array<struct<page_num:int,text:string>>").coalesce(1).write.mode("append").parquet(src)


def test_a_rejected_file_that_comes_back_and_a_run_of_repeats(spark, tmpdir_fresh):
    src, store, ckpt = f"{tmpdir_fresh}/src", f"{tmpdir_fresh}/store", f"{tmpdir_fresh}/ckpt"
    good = "Alice met Robert somewhere in a long enough sentence of this page."
    run = lambda: stream_ingest(spark, src, store, checkpoint=ckpt).awaitTermination()
    _drop(spark, src, [("x", "short"), ("y", good), ("y", good)])
    run()
    assert [r.id for r in read_store(spark, store, "documents").collect()] == ["y"]
    assert read_store(spark, store, "mentions").count() == 2
    _drop(spark, src, [("x", good)])
    run()
    assert sorted(r.id for r in read_store(spark, store, "documents").collect()) == ["x", "y"]
    _drop(spark, src, [("x", good), ("y", good)])
    run()
    status = read_store(spark, store, "status").filter("batch_id = 2").collect()
    assert sorted((r.doc_id, r.status) for r in status) == [("x", "skipped"), ("y", "skipped")]
    releases = read_store(spark, store, "releases").orderBy("batch_id").collect()
    assert [(r.batch_id, r.docs_added, r.entities_found) for r in releases] == [(0, 1, 2), (1, 1, 2), (2, 0, 0)]
    assert read_store(spark, store, "page_index").count() == 2
