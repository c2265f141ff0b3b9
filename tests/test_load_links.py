"""Load path idempotence and link planning (FIXTURES C: same input twice,
same filename in two corpora, manifest and on-disk skips)."""

import time
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions.anchors import RAW_TEXT, hrefs
from quarry.operators import chunks as C
from quarry.operators import links as L
from quarry.operators import load as D
from quarry.sources import fixtures as fx

from conftest import SF001

RUN = "2025-01-01 00:00:00"


def _inputs(spark):
    files = fx.text_documents(spark, SF001).select(F.col("id").alias("doc_id"), "corpus", "filename",
                                                   "file_path", "page_count")
    return files, fx.text_pages(spark, SF001)


def test_second_run_adds_nothing(spark):
    files, pages = _inputs(spark)
    empty_docs = spark.createDataFrame([], "id string, filename string")
    empty_ents = spark.createDataFrame([], "id long, name string, type string, created_at timestamp")
    run1 = D.ingest_batch(files, pages, empty_docs, empty_ents, RUN)
    docs1, ents1 = run1["documents"].cache(), run1["entities"].cache()
    assert docs1.count() > 0 and ents1.count() > 0
    run2 = D.ingest_batch(files, pages, docs1.select("id", "filename"), ents1, RUN)
    assert run2["documents"].count() == 0
    assert run2["entities"].count() == 0
    assert run2["mentions"].count() == 0
    st = {r.status for r in run2["status"].collect()}
    assert st == {"skipped"}
    rel = run2["releases"].collect()
    assert all(r.docs_added == 0 and r.entities_found == 0 for r in rel)
    assert len(rel) == files.select("corpus").distinct().count()


def test_same_filename_in_two_corpora(spark):
    files = spark.createDataFrame([("a1", "alpha", "x.pdf", "/a/x.pdf", 1), ("b1", "beta", "x.pdf", "/b/x.pdf", 1)],
                                  "doc_id string, corpus string, filename string, file_path string, page_count int")
    pages = spark.createDataFrame([("a1", 1, "A" * 60 + " Alice"), ("b1", 1, "B" * 60 + " Bobby")],
                                  "doc_id string, page_num int, text string")
    run = D.ingest_batch(files, pages, spark.createDataFrame([], "id string, filename string"),
                         spark.createDataFrame([], "id long, name string, type string, created_at timestamp"), RUN)
    docs = run["documents"].collect()
    assert [(d.id, d.corpus) for d in docs] == [("a1", "alpha")]  # first in corpus order
    st = {r.doc_id: r.status for r in run["status"].collect()}
    assert st == {"a1": "ok", "b1": "skipped"}


def test_new_chunks_twice(spark):
    ch = C.chunk_text(fx.text_pages(spark, SF001)).select("chunk_id").cache()
    assert C.new_chunks(ch, ch).count() == 0
    rep = C.build_report(ch, ch.limit(0)).first()
    assert (rep.existing, rep.processed, rep.total) == (0, ch.count(), ch.count())


def test_plan_downloads_with_manifest_and_listing(spark):
    links = spark.createDataFrame(
        [("s", 1, 0, "https://x.org/a.pdf"), ("s", 1, 1, "https://x.org/b.pdf"),
         ("s", 2, 0, "https://x.org/q/a.pdf?v=2"), ("s", 2, 1, "https://x.org/c.pdf"),
         ("s", 3, 0, "https://x.org/d.pdf")], "source string, page_id long, pos int, link string")
    manifest = spark.createDataFrame([("b.pdf",)], "filename string")
    present = spark.createDataFrame([("d.pdf",)], "filename string")
    plan = L.plan_downloads(L.with_filenames(links), manifest, present)
    got = {(r.page_id, r.pos): r.status for r in plan.collect()}
    assert got == {(1, 0): "fetch", (1, 1): "skip", (2, 0): "skip", (2, 1): "fetch", (3, 0): "skip"}
    c = L.harvest_counts(plan).first()
    assert (c.found, c.to_fetch, c.skipped) == (5, 2, 3)
    rows = L.manifest_rows(plan, "alpha", "2025-01-02").collect()
    assert sorted(r.filename for r in rows) == ["a.pdf", "c.pdf"]


def test_extract_links_skips_script_and_comments(spark):
    html = ('<html><script>var s="<a href=\\"/no1\\">";</script><!-- <a href="/no2"> -->'
            '<A HREF="/yes1">x</A><a class=k href=\'/yes2?a=1&amp;b=2\'>y</a><a href=/yes3>z</a></html>')
    pages = spark.createDataFrame([("s", 1, "u", html)], "source string, page_id long, url string, html string")
    got = [r.href for r in L.extract_links(pages).orderBy("pos").collect()]
    assert got == ["/yes1", "/yes2?a=1&b=2", "/yes3"]


def test_integrity_audit_finds_violations(spark):
    docs = spark.createDataFrame([("1", "x.pdf"), ("1", "y.pdf"), ("2", "y.pdf")], "id string, filename string")
    ents = spark.createDataFrame([(1, "A", "T"), (2, "A", "T")], "id long, name string, type string")
    ments = spark.createDataFrame([(5, 1, "1"), (5, 3, "9")], "id long, entity_id long, doc_id string")
    reds = spark.createDataFrame([(1, "7")], "id long, doc_id string")
    raw = spark.createDataFrame([("1", 0), ("1", 0), ("8", 0)], "doc_id string, block int")
    got = {r.rule: r.violations for r in D.integrity_audit(docs, ents, ments, reds, raw_docs=raw).collect()}
    assert got == {"documents.id unique": 1, "documents.filename unique": 1, "entities.id unique": 0,
                   "entities.(name,type) unique": 1, "mentions.id unique": 1, "redactions.id unique": 0,
                   "raw_docs.(doc_id,block) unique": 1, "raw_docs.doc_id -> documents": 1,
                   "mentions.entity_id -> entities": 1, "mentions.doc_id -> documents": 1,
                   "redactions.doc_id -> documents": 1}


class _Anchors(HTMLParser):
    """What an HTML parser reads, the last of repeated attributes winning. Raw elements hold text, as the
    standard has it (older versions of the parser know two of them only)."""

    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        value = dict(attrs).get("href") if tag == "a" else None
        if value is not None:
            self.found.append(value)
        if tag in RAW_TEXT:
            self.set_cdata_mode(tag)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)


_value = st.text(st.sampled_from("ab/ .?=&;#x>é<\n"), max_size=8)
_attribute = st.one_of(
    st.builds(lambda n, v, q: f"{n}={q}{v.replace(q, '')}{q}", st.sampled_from(["href", "HREF", "data-href", "class", "title"]),
              st.one_of(_value, st.sampled_from(["/O'Brien.pdf", "/p/q&amp;r.pdf", "/n&#39;s&hellip;t.pdf", "a&copy=1", "a&lt"])),
              st.sampled_from(["'", '"'])),
    st.sampled_from(["href=/bare.pdf", "href = '/spaced.pdf'", "download", "title=x", "href=/a&amp;b", "href", "href=", "href\n=\n/two"]))
_tag = st.builds(lambda name, attributes, end: f"<{name} {' '.join(attributes)}{end}",
                 st.sampled_from(["a", "A", "abbr", "p", "img", "textarea", "title", "script", "STYLE"]),
                 st.lists(_attribute, max_size=4), st.sampled_from([">", " >", "\n>"]))
_markup = st.one_of(_tag, st.sampled_from(["x", " < ", "a > b", "&lt;a href=x>", "<!-- <a href='/c'> -->", "<!DOCTYPE html>", "</a>", "</p >",
                                           "</textarea>", "</TITLE>", "</script>", "</style\n>", "<?php x ?>", "<!-- > -->"]))


@settings(max_examples=1500, deadline=None, database=None)
@given(st.lists(_markup, min_size=1, max_size=8))
def test_hrefs_equal_an_html_parser(parts):
    """Spaces, quotes, repeated href, > and < in values, references, bare values, comments, raw elements."""
    page = "<p>" + "".join(parts) + "</p>"
    parser = _Anchors()
    parser.feed(page)
    assert hrefs(page) == parser.found, page


def test_hrefs_defined_cases():
    assert hrefs(None) == hrefs("") == []
    assert hrefs("""<a href="/a b.pdf"><a href="/O'Brien.pdf"><a data-href="/x" href=/y.pdf><a title="a>b" href="/z.pdf">""") == [
        "/a b.pdf", "/O'Brien.pdf", "/y.pdf", "/z.pdf"]
    assert hrefs('<textarea><a href="/t"></textarea><a href="/u"><title><a href=/v></title ><iframe><a href=/w></IFRAME><a href=/x>') == ["/u", "/x"]
    assert hrefs('<a href="/1" href="/2"><a href="/3" href><a href=""><a href=>') == ["/2", "", ""]
    assert hrefs('<a href="/1"><a href="/never ended>text<a href=/2>') == ["/1"]
    assert hrefs('<a href=/1><!-- <a href=/2>') == hrefs("<a href=/1><script><a href=/2>") == hrefs("<a href=/1><a href=/2 ") == ["/1"]
    assert hrefs("<!--><a href=/1><!---><a href=/2><!-- --!><a href=/3>") == ["/1", "/2", "/3"]


@pytest.mark.parametrize("page", [
    "<a " + " ".join(f"k{i}='v'" for i in range(50_000)) + " href=/last>",
    "<a href=/last><p title=\"" + "word href=x " * 1_000_000,
    "<a href=/last><a class='" + "x" * 10_000_000 + "'>",
    "<a href=/last>" + "<a " * 1_000_000,
    "<a href=/last>" + "<!-" * 1_000_000 + "<script>" * 1_000_000,
    "<a href=/last>" + "<p = = ' " * 300_000,
    "<a " + "\n" * 5_000_000 + "href=/last>",
], ids=["attributes", "open quote", "one value", "open tags", "openers", "equals signs", "blank"])
def test_hrefs_take_linear_time(page):
    start = time.monotonic()
    assert hrefs(page)[:1] == ["/last"]
    assert time.monotonic() - start < 20


def test_extract_links_survives_large_tags(spark):
    large = "<a " + " ".join(f"k{i}='v'" for i in range(50_000)) + " href=/x.pdf>"
    pages = spark.createDataFrame([(1, large, 7, "h"), (2, None, 7, "h"), (3, "", 7, "h"), (4, "<a href=/b.PDF><a href=/c>", 7, "h")],
                                  "page_id long, html string, pos long, href string")
    links = L.extract_links(pages, ".pdf")
    assert links.columns == ["page_id", "pos", "href"]
    assert sorted(map(tuple, links.collect())) == [(1, 0, "/x.pdf"), (4, 0, "/b.PDF")]
    assert L.extract_links(pages.limit(0)).count() == 0
