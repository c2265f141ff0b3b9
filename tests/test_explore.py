"""Star queries: paging rules, empty inputs, F15, and properties."""

import pytest
from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.operators import explore as X
from quarry.sources import fixtures as fx

from conftest import SF001


def test_paging_rules(spark):
    docs = fx.star_documents(spark, SF001)
    full = X.list_documents(docs, limit=None).collect()
    assert X.list_documents(docs, limit=0).count() == 0
    assert X.list_documents(docs, page=1, limit=100).collect() == full[:100]
    pages = [X.list_documents(docs, page=p, limit=100).collect() for p in (1, 2)]
    assert pages[0] + pages[1] == full[:200]
    assert X.list_documents(docs, page=10 ** 6, limit=100).count() == 0
    for bad in (dict(limit=101), dict(limit=-1), dict(page=0)):
        with pytest.raises(ValueError):
            X.list_documents(docs, **bad)
    with pytest.raises(ValueError):
        X.changelog(fx.star_releases(spark, SF001), limit=101)


def test_totals_without_redactions_are_zero(spark):
    docs = fx.star_documents(spark, SF001)
    empty = fx.star_redactions(spark, SF001).limit(0)
    r = X.redaction_totals(empty, docs).first()
    assert (r.total_redactions, r.total_chars_redacted) == (0, 0)


def test_totals_equal_sum_by_corpus(spark):
    docs, red = fx.star_documents(spark, SF001), fx.star_redactions(spark, SF001)
    tot = X.redaction_totals(red, docs).first().total_redactions
    by = X.redactions_by_corpus(red, docs).agg(F.sum("total_redactions")).first()[0]
    assert tot == by


def test_get_entity_by_name_picks_smallest_id(spark):
    ents = spark.createDataFrame([(5, "Paris", "GPE"), (2, "Paris", "PERSON"), (9, "Rome", "GPE")],
                                 "id long, name string, type string")
    assert [tuple(r) for r in X.get_entity(ents, "Paris").collect()] == [(2, "Paris", "PERSON")]
    assert X.get_entity(ents, "Paris", all_types=True).count() == 2
    assert X.get_entity(ents, "Nowhere").count() == 0


def test_cooccurrence_equals_raw_self_join(spark):
    m = fx.star_supplier_mentions(spark, SF001)
    ents = fx.star_supplier_entities(spark, SF001)
    focus = m.select("entity_id").distinct().orderBy("entity_id").limit(3)
    got = {(r.focus_id, r.name, r.mention_pairs, r.shared_docs)
           for r in X.entity_cooccurrence(m, ents, focus, k=1000).collect()}
    m1, m2 = m.alias("m1"), m.alias("m2")
    raw = (m1.join(focus.withColumnRenamed("entity_id", "f"), F.col("m1.entity_id") == F.col("f"))
           .join(m2, (F.col("m1.doc_id") == F.col("m2.doc_id")) & (F.col("m2.entity_id") != F.col("f")))
           .join(ents, F.col("m2.entity_id") == ents.id)
           .groupBy("f", "name").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("m1.doc_id").alias("d")))
    assert got == {(r.f, r.name, r.n, r.d) for r in raw.collect()}
    # symmetry: pairs(a, b) == pairs(b, a)
    pairs = {(r.focus_id, r.name): r.mention_pairs for r in
             X.entity_cooccurrence(m, ents, m.select("entity_id").distinct(), k=1000).collect()}
    names = {r.id: r.name for r in ents.collect()}
    ids = {v: k for k, v in names.items()}
    for (f, n), v in list(pairs.items())[:200]:
        assert pairs[(ids[n], names[f])] == v


def test_document_entities_top_k(spark):
    got = X.document_entities(fx.star_mentions(spark, SF001), fx.star_entities(spark, SF001), k=2)
    assert got.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
    one = got.select("doc_id").first().doc_id
    single = X.document_entities(fx.star_mentions(spark, SF001), fx.star_entities(spark, SF001),
                                 doc_id=one, k=2).collect()
    assert sorted(single) == sorted(got.filter(F.col("doc_id") == one).collect())


def test_profile_has_every_document(spark):
    docs = fx.star_documents(spark, SF001, with_page_count=True)
    p = X.document_profile(docs, fx.star_mentions(spark, SF001), fx.star_entities(spark, SF001),
                           fx.star_redactions(spark, SF001))
    assert p.count() == docs.count()
    assert p.filter(F.col("entities").isNull() | F.col("total_redactions").isNull()).count() == 0
    # the bulk profile equals the one-document record for a redacted document
    red = fx.star_redactions(spark, SF001)
    one = red.select("doc_id").first().doc_id
    stored = spark.createDataFrame(
        [(one, "c", "f", "p", 3, 1, [(3, " last\n", 0, 0, 1)]), (one, "c", "f", "p", 3, 0, [(1, "a b", 0, 0, 2), (2, "", 0, 0, 0)]),
         ("other", "c", "f", "p", 1, 0, [(1, "x", 0, 0, 1)])], S.RAW_DOCS)
    rec = X.document_record(docs, fx.star_mentions(spark, SF001), fx.star_entities(spark, SF001), red, stored, one)
    assert [(r.page_num, r.text, r.word_count) for r in rec["pages"].collect()] == [(1, "a b", 2), (2, "", 0), (3, "last", 1)]
    row = p.filter(F.col("id") == one).first()
    r_rows = rec["redactions"].collect()
    assert row.redacted_pages == len(r_rows)
    assert row.total_redactions == sum(r.redaction_count for r in r_rows)
    assert [(e.name, e.mentions) for e in row.entities] == \
        [(e.name, e.mentions) for e in rec["entities"].orderBy(F.col("mentions").desc(), "name", "type").collect()]


def test_timeline_chronological(spark):
    names = ["1963-11-22", "November 22, 1963", "3 April 1968", "Aug 9, 1974", "11/22/1963", "1961",
             "last week"]
    ents = spark.createDataFrame([(i, n, "DATE") for i, n in enumerate(names)] + [(99, "Paris", "GPE")],
                                 "id long, name string, type string")
    ments = spark.createDataFrame([(i, "d1", 1, f"c{i}") for i in list(range(len(names))) + [99]],
                                  "entity_id long, doc_id string, page_num int, context string")
    docs = spark.createDataFrame([("d1", "a", "d1.pdf")], "id string, corpus string, filename string")
    plain = X.timeline(ments, docs, ents, limit=None).collect()
    assert len(plain) == len(names) and "date" not in plain[0].asDict()
    rows = X.timeline(ments, docs, ents, limit=None, chronological=True).collect()
    got = [(r.entity_name, str(r.date) if r.date else None) for r in rows]
    assert got == [("1961", "1961-01-01"), ("11/22/1963", "1963-11-22"), ("1963-11-22", "1963-11-22"),
                   ("November 22, 1963", "1963-11-22"), ("3 April 1968", "1968-04-03"),
                   ("Aug 9, 1974", "1974-08-09"), ("last week", None)]
    assert X.timeline(ments, docs, ents, entity="1963", limit=None).count() == 3


def test_redaction_corpus_option(spark):
    docs, red = fx.star_documents(spark, SF001), fx.star_redactions(spark, SF001)
    by = {r.corpus: r.total_redactions for r in X.redactions_by_corpus(red, docs).collect()}
    for c, n in by.items():
        assert X.redaction_totals(red, docs, corpus=c).first().total_redactions == n
        assert {r.corpus for r in X.most_redacted(red, docs, corpus=c).collect()} == {c}


def test_pages_need_the_stored_schema(spark):
    texts = spark.createDataFrame([("d", 0, ["a"])], "doc_id string, block int, pages array<string>")
    with pytest.raises(ValueError, match="RAW_DOCS"):
        X.document_pages(texts, "d")
