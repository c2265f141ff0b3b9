import duckdb
import pytest
from llm_rows import SF, corpus, make_docs  # noqa: F401

import __spark_entry__ as entry
import corpus_pipeline
from quarry.llm import queries as Q
from quarry.llm.common import clear_scratch, cut, table

SMALL = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = entry.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()) == list(range(1, 14))
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


def test_stages_keep_their_contract(spark):
    docs = table(spark, SMALL, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = cut(stage(spark, docs, SMALL), "test-stage")
        assert docs.columns == columns, name
        after, ids = docs.count(), docs.select("doc_id").distinct().count()
        if name in ("toxicity", "minhash near-dedup"):
            assert 0 < after == ids <= before
        elif name == "line dedup":
            assert after == before
        else:
            assert ids <= before and docs.groupBy("doc_id").count().where("count > 2").count() == 0
        before = ids
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert pieces.select("doc_id").distinct().count() == before
    assert corpus_pipeline.run(spark, SMALL).count() == pieces.count()


def _stored(spark, folder, rows):
    """A data folder of awkward documents with columns of clashing names, and labels for some."""
    make_docs(spark, rows).write.parquet(f"{folder}/documents.parquet")
    ids = sorted({i for i, *_ in rows if i is not None})
    spark.createDataFrame([(i, i % 2, int(i % 7 == 0)) for i in ids[::2]], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_awkward_documents_go_through_all_stages(spark, corpus, tmp_path):
    folder = _stored(spark, tmp_path, corpus)
    docs = table(spark, folder, "documents").withColumnRenamed("n", "n_dropped").withColumnRenamed("digest", "row")
    first = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = cut(stage(spark, docs, folder), "test-stage")
        assert docs.schema.simpleString() == first.schema.simpleString(), name
        assert docs.join(first.select("doc_id", "source"), ["doc_id"], "left_anti").where("doc_id IS NOT NULL").count() == 0
        assert docs.where("n_dropped IS DISTINCT FROM 1 OR key IS DISTINCT FROM 'x'").count() == 0  # further columns stay as they are
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.select("doc_id").collect()}
    assert corpus_pipeline.run(spark, folder).count() == len(pieces)


def test_an_empty_table_goes_through_all_stages(spark, tmp_path):
    assert corpus_pipeline.run(spark, _stored(spark, tmp_path, [])).count() == 0


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_sql_twins(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    df = Q.queries()[name](spark, SF)
    expected = con.sql(Q.oracle_sql()[name]).select(", ".join(df.columns)).fetchall()
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, expected))


def test_scratch_is_cleared(spark):
    df = cut(spark.range(5), "gone")
    clear_scratch(spark)
    with pytest.raises(Exception, match="FILE|PATH"):
        df.collect()
