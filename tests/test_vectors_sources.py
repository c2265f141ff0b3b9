"""Vector top-k against brute force; answer path edge cases; file sources."""

import os

import numpy as np
from pyspark.sql import functions as F

from quarry.operators import answers as A
from quarry.operators import vectors as V
from quarry.sources import files as IO
from quarry.sources import fixtures as fx

from conftest import SF001


def _brute(chunks, queries, k, filt=False):
    cs = [(r.chunk_id, np.asarray(r.embedding, dtype=np.float64), r.metadata.corpus) for r in chunks.collect()]
    out = set()
    for q in queries.collect():
        qv = np.asarray(q.embedding, dtype=np.float64)
        qv = qv / np.linalg.norm(qv)
        ds = []
        for cid, v, corp in cs:
            if filt and q.corpus is not None and corp != q.corpus:
                continue
            ds.append((1 - float(v @ qv / np.linalg.norm(v)), cid))
        for rank, (d, cid) in enumerate(sorted(ds)[:k], start=1):
            out.add((q.question_id, rank, cid))
    return out


def test_exact_topk_equals_brute_force(spark):
    chunks = fx.vector_chunks(spark, SF001)
    qs = fx.label_centroid_questions(spark, SF001)
    got = {(r.question_id, r.rank, r.chunk_id) for r in V.vector_topk(chunks, qs, 5).collect()}
    assert got == _brute(chunks, qs, 5)
    qf = qs.withColumn("corpus", F.col("question_id").cast("string"))
    gotf = {(r.question_id, r.rank, r.chunk_id) for r in V.vector_topk(chunks, qf, 3).collect()}
    assert gotf == _brute(chunks, qf, 3, filt=True)


def test_topk_blocks_and_ties(spark, monkeypatch):
    # duplicated vectors tie exactly: ranks follow chunk_id
    rows = [(str(i), [1.0, 0.0], ("a", "a", "x.pdf", 1)) for i in range(6)] + \
           [("z", [0.0, 1.0], ("a", "a", "z.pdf", 1))]
    chunks = spark.createDataFrame(rows, "chunk_id string, embedding array<float>, "
                                         "metadata struct<doc_id:string,corpus:string,filename:string,page_num:int>")
    qs = spark.createDataFrame([(1, [1.0, 0.0], None), (2, [0.0, 2.0], None)],
                               "question_id long, embedding array<float>, corpus string")
    monkeypatch.setattr(V, "MAX_QUERY_BYTES", 16)  # one query per block
    got = sorted((r.question_id, r.rank, r.chunk_id) for r in V.vector_topk(chunks.repartition(3), qs, 3).collect())
    assert got == [(1, 1, "0"), (1, 2, "1"), (1, 3, "2"), (2, 1, "z"), (2, 2, "0"), (2, 3, "1")]


def test_ask_batch_no_hits(spark):
    chunks = fx.vector_chunks(spark, SF001)
    qs = fx.label_centroid_questions(spark, SF001).limit(2).withColumn("question", F.lit("q?"))
    qs = qs.withColumn("corpus", F.when(F.col("question_id") == F.lit(0), F.lit("no-such-corpus")))
    out = {r.question_id: r for r in A.ask_batch(chunks, qs).collect()}
    for qid, r in out.items():
        if qid == 0:
            assert r.answer == "No relevant documents found." and r.citations == [] and r.prompt is None
        else:
            assert r.answer is None and len(r.citations) == 5
            assert r.prompt.startswith("Answer the question using ONLY") and r.prompt.endswith("Answer:")
            assert "[Source 1: " in r.prompt


def test_scan_corpora_and_manifest(spark, tmpdir_fresh):
    for corpus in ("alpha", "beta"):
        os.makedirs(f"{tmpdir_fresh}/{corpus}/sub")
        for name, data in (("a.pdf", b"%PDF-1.4 x"), ("b.PDF", b"%PDF-1.4"), ("c.pdf", b"<html>")):
            with open(f"{tmpdir_fresh}/{corpus}/{name}", "wb") as f:
                f.write(data)
        with open(f"{tmpdir_fresh}/{corpus}/sub/d.pdf", "wb") as f:
            f.write(b"%PDF-")
    files = IO.scan_corpora(spark, {c: f"{tmpdir_fresh}/{c}" for c in ("alpha", "beta")}, with_content=True)
    got = sorted((r.corpus, r.filename) for r in files.collect())
    assert got == [("alpha", "a.pdf"), ("alpha", "c.pdf"), ("beta", "a.pdf"), ("beta", "c.pdf")]
    gate = {(r.corpus, r.filename): r.is_pdf for r in IO.pdf_gate(files).collect()}
    assert gate[("alpha", "a.pdf")] and not gate[("alpha", "c.pdf")]
    man = f"{tmpdir_fresh}/manifest"
    rows = spark.createDataFrame([("alpha", "a.pdf", "https://x/a.pdf", None, 0)],
                                 "corpus string, filename string, url string, fetched date, page_count int")
    IO.append_manifest(rows, man)
    IO.append_manifest(rows.withColumn("filename", F.lit("b.pdf")), man)
    assert sorted(r.filename for r in IO.read_manifest(spark, man).collect()) == ["a.pdf", "b.pdf"]


def test_lsh_survives_zero_vectors(spark):
    chunks = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 0.0]), ("c", [0.9, 0.1])], "chunk_id string, embedding array<float>")
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0])], "question_id long, embedding array<float>")
    got = {(r.question_id, r.chunk_id): r.distance for r in V.vector_topk_lsh(chunks, queries, k=3).collect()}
    assert got[1, "a"] == 0.0 and all(d == 1.0 for (q, c), d in got.items() if q == 2 or c == "b")


def test_topk_in_tiles_and_blocks(spark, monkeypatch):
    chunks, queries = fx.vector_chunks(spark, SF001), fx.label_centroid_questions(spark, SF001)
    whole = sorted(map(tuple, V.vector_topk(chunks, queries).collect()))
    monkeypatch.setattr(V, "TILE", 3)
    assert sorted(map(tuple, V.vector_topk(chunks, queries).collect())) == whole
    monkeypatch.setattr(V, "MAX_QUERY_BYTES", 64 * 8 * 4)
    assert sorted(map(tuple, V.vector_topk(chunks, queries).collect())) == whole
