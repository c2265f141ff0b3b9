"""Sinks and readers round trip (I4-I8), P1, Q3 and Q6 on written tables."""

from pyspark.sql import functions as F

from quarry.operators import chunks as C
from quarry.operators import explore as X
from quarry.operators import pages as P
from quarry.sources import files as IO
from quarry.sources import fixtures as fx

from conftest import SF001


def test_raw_docs_round_trip(spark, tmpdir_fresh):
    pages = P.page_facts(fx.text_pages(spark, SF001)) \
        .withColumn("redaction_count", F.when(F.col("page_num") == 2, F.lit(3)).otherwise(F.lit(0))) \
        .withColumn("estimated_chars_redacted", F.col("redaction_count") * 10)
    docs = fx.text_documents(spark, SF001)
    IO.write_table(P.nest_pages(pages, docs), f"{tmpdir_fresh}/raw", partition_by=["corpus"])
    raw = IO.read_raw_docs(spark, f"{tmpdir_fresh}/raw")
    assert raw.count() == docs.count()
    back = P.explode_pages(raw)
    assert sorted((r.doc_id, r.page_num, r.text) for r in back.collect()) == \
        sorted((r.doc_id, r.page_num, r.text) for r in pages.select("doc_id", "page_num", "text").collect())
    # Q6: a document without a raw record gets an empty page list
    one = docs.select("id").first().id
    got = X.document_pages(raw, one).collect()
    assert [r.page_num for r in got] == list(range(1, len(got) + 1)) and {r.doc_id for r in got} == {one}
    assert X.document_pages(raw, "no-such-doc").count() == 0
    # Q3
    assert X.get_document(docs, one).count() == 1 and X.get_document(docs, "nope").count() == 0
    # One row per page with a redaction
    IO.append_redactions(pages, f"{tmpdir_fresh}/red", created_at="2025-01-01 00:00:00")
    red = spark.read.parquet(f"{tmpdir_fresh}/red")
    assert red.count() == pages.filter("redaction_count > 0").count()
    assert red.filter("estimated_chars != redaction_count * 10").count() == 0


def test_write_chunks(spark, tmpdir_fresh):
    ch = C.with_metadata(C.chunk_text(fx.text_corpus_pages(spark, SF001))) \
        .withColumn("embedding", F.array(F.lit(1.0).cast("float")))
    IO.write_chunks(ch, f"{tmpdir_fresh}/chunks", max_records_per_file=100)
    IO.write_chunks(C.new_chunks(ch, spark.read.parquet(f"{tmpdir_fresh}/chunks")), f"{tmpdir_fresh}/chunks")
    stored = spark.read.parquet(f"{tmpdir_fresh}/chunks")
    assert stored.count() == ch.count() == stored.select("chunk_id").distinct().count()
    assert set(stored.columns) == {"chunk_id", "text", "embedding", "metadata"}
