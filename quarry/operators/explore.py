"""Exploration queries over the star schema (Q1-Q17).

Every function is ``DataFrame -> DataFrame``. Where the reference answers for
one id per request, ``None`` means "all keys in one job" (the bulk form), and
top-n per key is a window with ``row_number() <= n`` (partial limit below the
shuffle). Orderings always end in a key so that pages never overlap.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.functions.paging import paginate, top_k_per_group
from quarry.functions.text import name_contains


def _all(conds: list[Column]) -> Column | None:
    return reduce(lambda a, b: a & b, conds) if conds else None


# -- documents ---------------------------------------------------------------

def list_documents(documents: DataFrame, corpus: str | None = None, page: int = 1,
                   limit: int | None = S.LIST_LIMITS[0]) -> DataFrame:
    """Q1: six columns, newest first (id breaks ties), one page."""
    d = documents
    if corpus:
        d = d.filter(F.col("corpus") == corpus)
    d = d.select("id", "corpus", "filename", "page_count", "is_scanned", "created_at")
    return paginate(d, [F.col("created_at").desc(), F.col("id")], page, limit, S.LIST_LIMITS[1])


def count_documents(documents: DataFrame, corpus: str | None = None) -> DataFrame:
    """Q2: total under the same filter."""
    d = documents.filter(F.col("corpus") == corpus) if corpus else documents
    return d.agg(F.count(F.lit(1)).alias("total"))


def get_document(documents: DataFrame, doc_id: str) -> DataFrame:
    """Q3: all columns of one document; empty when not found."""
    return documents.filter(F.col("id") == doc_id)


def document_entities(mentions: DataFrame, entities: DataFrame, doc_id: str | None = None,
                      k: int = S.DOC_TOP_ENTITIES) -> DataFrame:
    """Q4: entities of a document by mention count, top k (bulk: every document).

    Mentions are counted per (doc, entity) before the dimension join, so the
    join sees one row per pair instead of one per mention. Hardly a pair comes
    twice in one input split, so the pairs are counted where they meet: a count before the
    shuffle would hold a split's pairs in memory and save nothing.
    """
    m = mentions if doc_id is None else mentions.filter(F.col("doc_id") == doc_id)
    c = m.select("doc_id", "entity_id").repartition("doc_id", "entity_id").groupBy("doc_id", "entity_id").agg(F.count(F.lit(1)).alias("mentions"))
    e = entities.select(F.col("id").alias("entity_id"), "name", "type")
    j = c.join(e, "entity_id")
    return top_k_per_group(j, ["doc_id"], [F.col("mentions").desc(), F.col("name"), F.col("type")], k) \
        .select("doc_id", "name", "type", "mentions")


def document_redactions(redactions: DataFrame, doc_id: str | None = None) -> DataFrame:
    """Q5: redacted pages of a document in page order."""
    r = redactions if doc_id is None else redactions.filter(F.col("doc_id") == doc_id)
    return r.select("doc_id", "page_num", "redaction_count", "estimated_chars") \
        .orderBy("doc_id", "page_num")


def document_pages(raw_docs: DataFrame, doc_id: str | None = None) -> DataFrame:
    """Q6: the pages of one document (of all, without ``doc_id``), one row per
    page in page order; a document without a raw record gives none."""
    from quarry.operators.pages import explode_pages
    r = raw_docs if doc_id is None else raw_docs.filter(F.col("doc_id") == doc_id)
    return explode_pages(r).orderBy("doc_id", "page_num")


def document_page_stats(raw_docs: DataFrame) -> DataFrame:
    """Q6 in bulk, without collecting any document's pages: page count,
    words and an order-independent digest per document (partial aggregates)."""
    from quarry.operators.pages import explode_pages, page_digest
    p = explode_pages(raw_docs)
    return p.groupBy("doc_id").agg(
        F.count(F.lit(1)).cast("int").alias("page_count"),
        F.sum("word_count").cast("long").alias("total_words"),
        F.sum(page_digest(F.col("page_num"), F.col("text"))).alias("pages_digest"))


def document_record(documents: DataFrame, mentions: DataFrame, entities: DataFrame,
                    redactions: DataFrame, raw_docs: DataFrame, doc_id: str,
                    k: int = S.DOC_TOP_ENTITIES) -> dict[str, DataFrame]:
    """Q7 for one document, as the reference answers it: the document row,
    its top entities, its redacted pages in page order and its page list."""
    return {"document": get_document(documents, doc_id),
            "entities": document_entities(mentions, entities, doc_id, k),
            "redactions": document_redactions(redactions, doc_id),
            "pages": document_pages(raw_docs, doc_id)}


def document_profile(documents: DataFrame, mentions: DataFrame, entities: DataFrame,
                     redactions: DataFrame, raw_docs: DataFrame | None = None,
                     k: int = S.DOC_TOP_ENTITIES) -> DataFrame:
    """Q7 for every document in one job: one row per document with its top-k
    entities (a list bounded by k) and redaction / page aggregates.

    Nothing unbounded is collected per document: the per-page redaction list
    of Q5 stays a flat table (``document_redactions``), summarised here by
    partial aggregates, so a document with a huge page count costs no more
    memory than any other."""
    ents = (document_entities(mentions, entities, None, k)
            .groupBy("doc_id")
            .agg(F.array_sort(F.collect_list(F.struct(
                (-F.col("mentions")).alias("_o"), "name", "type", "mentions"))).alias("_e"))
            .select("doc_id", F.transform("_e", lambda x: F.struct(
                x["name"].alias("name"), x["type"].alias("type"),
                x["mentions"].alias("mentions"))).alias("entities")))
    reds = redactions.groupBy("doc_id").agg(
        F.count(F.lit(1)).cast("int").alias("redacted_pages"),
        F.sum("redaction_count").cast("long").alias("total_redactions"),
        F.sum("estimated_chars").cast("long").alias("total_chars"))
    out = (documents.join(ents, documents["id"] == ents["doc_id"], "left").drop("doc_id")
           .join(reds, documents["id"] == reds["doc_id"], "left").drop("doc_id"))
    out = out.withColumn("entities", F.coalesce("entities", F.array().cast(ents.schema["entities"].dataType)))
    for c in ("redacted_pages", "total_redactions", "total_chars"):
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0).cast(reds.schema[c].dataType)))
    if raw_docs is not None:
        st = document_page_stats(raw_docs).withColumnRenamed("page_count", "stored_pages")
        out = out.join(st, out["id"] == st["doc_id"], "left").drop("doc_id")
    return out


# -- entities ----------------------------------------------------------------

def list_entities(entities: DataFrame, mentions: DataFrame, type: str | None = None,
                  q: str | None = None, page: int = 1,
                  limit: int | None = S.LIST_LIMITS[0]) -> DataFrame:
    """Q8: entities with >= 1 mention and their count, most mentioned first.

    Filters apply to the (small) entity side first; mentions are then
    semi-joined to the surviving ids and counted before the name join.
    """
    conds = []
    if type:
        conds.append(F.col("type") == type)
    if q:
        conds.append(name_contains(F.col("name"), q))
    e = entities.select("id", "name", "type")
    m = mentions.select("entity_id")
    if conds:
        e = e.filter(_all(conds))
        m = m.join(e.select(F.col("id").alias("entity_id")), "entity_id", "left_semi")
    c = m.groupBy("entity_id").agg(F.count(F.lit(1)).alias("mention_count"))
    j = e.join(c, e["id"] == c["entity_id"]).select("id", "name", "type", "mention_count")
    return paginate(j, [F.col("mention_count").desc(), F.col("id")], page, limit, S.LIST_LIMITS[1])


def get_entity(entities: DataFrame, name: str | None = None, all_types: bool = False) -> DataFrame:
    """Q9: entity row by exact name (of every name, without one). The reference
    key is (name, type) but the lookup is by name, so one row wins: the smallest
    id. ``all_types`` returns every type instead."""
    e = entities if name is None else entities.filter(F.col("name") == name)
    if all_types:
        return e
    return e.groupBy("name").agg(F.min_by(F.struct(*entities.columns), F.col("id")).alias("e")) \
        .select("e.*")


def entity_appearances(mentions: DataFrame, documents: DataFrame, entity_id: int | None = None,
                       k: int = S.ENTITY_APPEARANCES) -> DataFrame:
    """Q10: filename, corpus, page, context of an entity's mentions, by corpus
    and filename, first k (bulk: every entity)."""
    m = mentions if entity_id is None else mentions.filter(F.col("entity_id") == entity_id)
    d = documents.select(F.col("id").alias("doc_id"), "filename", "corpus")
    j = m.select("entity_id", "doc_id", "page_num", "context").join(d, "doc_id")
    order = [F.col("corpus"), F.col("filename"), F.col("page_num"), F.col("context")]
    return top_k_per_group(j, ["entity_id"], order, k) \
        .select("entity_id", "filename", "corpus", "page_num", "context")


def entity_cooccurrence(mentions: DataFrame, entities: DataFrame, focus: DataFrame,
                        k: int = S.ENTITY_COOCCURRENCES) -> DataFrame:
    """Q11: for each focus entity, the other entities of its documents.

    ``mention_pairs`` is the reference's number (COUNT(*) of the
    mention x mention self join); ``shared_docs`` is the number of distinct
    documents. The self join is never materialised: the focus entities' documents
    come first, the mentions of those documents alone are counted per (doc,
    entity), and the products of counts are summed.
    ``focus`` has one column ``entity_id``.
    """
    m = mentions.select("doc_id", "entity_id")
    f = (m.join(focus.select(F.col("entity_id")).distinct(), "entity_id", "left_semi")
         .groupBy("doc_id", F.col("entity_id").alias("focus_id")).agg(F.count(F.lit(1)).alias("n1")))
    c = (m.join(f.select("doc_id"), "doc_id", "left_semi")
         .groupBy("doc_id", "entity_id").agg(F.count(F.lit(1)).alias("n")))
    pairs = (f.join(c, "doc_id").filter(F.col("entity_id") != F.col("focus_id"))
             .groupBy("focus_id", "entity_id")
             .agg(F.sum(F.col("n1") * F.col("n")).alias("mention_pairs"),
                  F.count(F.lit(1)).alias("shared_docs")))
    e = entities.select(F.col("id").alias("entity_id"), "name", "type")
    # The reference groups by (name, type) of the partner: equal to entity_id
    # when (name, type) is unique, as the upsert guarantees.
    j = pairs.join(e, "entity_id")
    return top_k_per_group(j, ["focus_id"], [F.col("mention_pairs").desc(), F.col("name"),
                                             F.col("type")], k) \
        .select("focus_id", "name", "type", "mention_pairs", "shared_docs")


def most_mentioned(mentions: DataFrame) -> DataFrame:
    """The entity with the most mentions (ties: smallest id), as a focus table."""
    return (mentions.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col("entity_id")).limit(1).select("entity_id"))


# Date layouts tried, in order, when a chronology is asked for.
DATE_FORMATS = ["yyyy-MM-dd", "MMMM d, yyyy", "d MMMM yyyy", "MMM d, yyyy", "MM/dd/yyyy", "yyyy"]


def parse_date(c: Column) -> Column:
    """First layout of DATE_FORMATS that parses the text; null otherwise."""
    return F.coalesce(*[F.try_to_date(c, f) for f in DATE_FORMATS])


def timeline(mentions: DataFrame, documents: DataFrame, entities: DataFrame,
             corpus: str | None = None, entity: str | None = None, date_type: str = "DATE",
             page: int = 1, limit: int | None = S.TIMELINE_LIMITS[0],
             chronological: bool = False) -> DataFrame:
    """Q12: mentions of type DATE with their document, by corpus and filename.

    As in the reference, by default no date is parsed and ``entity`` filters
    the DATE string itself. ``chronological=True`` adds the parsed ``date``
    and orders by it (unparsable last). The type filter runs on the entity
    dimension first, so only DATE mentions reach the document join.
    """
    e = entities.filter(F.col("type") == date_type)
    if entity:
        e = e.filter(name_contains(F.col("name"), entity))
    e = e.select(F.col("id").alias("entity_id"), F.col("name").alias("entity_name"),
                 F.col("type").alias("entity_type"))
    d = documents.select(F.col("id").alias("doc_id"), "filename", "corpus")
    if corpus:
        d = d.filter(F.col("corpus") == corpus)
    j = (mentions.select("entity_id", "doc_id", "page_num", "context")
         .join(e, "entity_id").join(d, "doc_id")
         .select("context", "page_num", "filename", "corpus", "entity_name", "entity_type"))
    order = [F.col("corpus"), F.col("filename"), F.col("page_num"), F.col("entity_name"),
             F.col("context")]
    if chronological:
        j = j.withColumn("date", parse_date(F.col("entity_name")))
        order = [F.col("date").asc_nulls_last()] + order
    return paginate(j, order, page, limit, S.TIMELINE_LIMITS[1])


# -- redactions --------------------------------------------------------------

def _redactions_per_document(redactions: DataFrame, documents: DataFrame,
                             corpus: str | None = None) -> DataFrame:
    """Per-document sums joined to the document attributes. The sum runs
    map-side before the shuffle; the join also drops orphan redaction rows.
    A corpus filter applies to the (pushed-down) document scan."""
    r = redactions.groupBy("doc_id").agg(
        F.sum("redaction_count").alias("total_redactions"),
        F.sum("estimated_chars").alias("total_chars"))
    d = documents.select(F.col("id").alias("doc_id"), "filename", "corpus")
    if corpus:
        d = d.filter(F.col("corpus") == corpus)
    return r.join(d, "doc_id")


def redaction_totals(redactions: DataFrame, documents: DataFrame, corpus: str | None = None) -> DataFrame:
    """Q13: total redactions and characters; 0 (not null) without rows.
    ``corpus`` (accepted and ignored by the reference) filters when given."""
    p = _redactions_per_document(redactions, documents, corpus)
    return p.agg(F.coalesce(F.sum("total_redactions"), F.lit(0)).cast("long").alias("total_redactions"),
                 F.coalesce(F.sum("total_chars"), F.lit(0)).cast("long").alias("total_chars_redacted"))


def redactions_by_corpus(redactions: DataFrame, documents: DataFrame, corpus: str | None = None) -> DataFrame:
    """Q14: documents with redactions and total redactions per corpus.

    After the per-document sum every row is one document, so the
    ``COUNT(DISTINCT d.id)`` is a plain count (no distinct expand).
    The reference accepts and ignores a corpus argument; here it filters.
    """
    p = _redactions_per_document(redactions, documents, corpus)
    return p.groupBy("corpus").agg(F.count(F.lit(1)).alias("docs_with_redactions"),
                                   F.sum("total_redactions").cast("long").alias("total_redactions"))


def most_redacted(redactions: DataFrame, documents: DataFrame, k: int = S.MOST_REDACTED,
                  corpus: str | None = None) -> DataFrame:
    """Q15: the k documents with the most redactions (ties by id)."""
    p = _redactions_per_document(redactions, documents, corpus)
    return p.orderBy(F.col("total_redactions").desc(), F.col("doc_id")).limit(k) \
        .select("filename", "corpus", F.col("total_redactions").cast("long").alias("total_redactions"))


# -- changelog ---------------------------------------------------------------

def changelog(releases: DataFrame, limit: int = S.CHANGELOG_LIMITS[0]) -> DataFrame:
    """Q16: runs newest first (id breaks ties), at most ``limit`` <= 100."""
    if limit < 0 or limit > S.CHANGELOG_LIMITS[1]:
        raise ValueError(f"limit must be in [0, {S.CHANGELOG_LIMITS[1]}]")
    return releases.orderBy(F.col("run_date").desc(), F.col("id").desc()).limit(limit)


def changelog_feed(releases: DataFrame) -> DataFrame:
    """The last 20 runs as feed items (title, description, pubDate)."""
    r = changelog(releases, S.FEED_ITEMS)
    return r.select(
        F.concat(F.upper("corpus"), F.lit(" - "), F.col("docs_added").cast("string"),
                 F.lit(" docs added")).alias("title"),
        F.col("notes").alias("description"),
        F.col("run_date").alias("pubDate"),
    )
