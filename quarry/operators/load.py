"""Star-schema load (D1-D8): incremental, idempotent, keyed by stable hashes.

The reference loads one file at a time with INSERT OR IGNORE and
autoincrement ids. Here a run is one DAG over all candidate files:
anti-joins replace the "already there?" lookups, entity and mention ids are
64-bit content hashes (``xxhash64``) so reruns give the same keys without a
global sort, documents keep the id of their file, and integrity -- colliding
hashes included -- is checked by audit queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry import schemas as S


def entity_id(name, type_):
    """Stable entity key for (name, type)."""
    return F.xxhash64(name, type_)


def skip_ingested(candidates: DataFrame, documents: DataFrame) -> DataFrame:
    """Drop candidate files whose filename is already loaded (across
    corpora, as the reference does)."""
    return candidates.join(documents.select("filename"), "filename", "left_anti")


def upsert_entities(mentions: DataFrame, entities: DataFrame | None = None,
                    created_at=None) -> DataFrame:
    """New (name, type) pairs not yet in ``entities``, with their ids.

    ``mentions`` carries ``name`` and ``type``; the distinct runs map-side
    first. Returns only the rows to append.
    """
    new = mentions.select("name", "type").distinct()
    if entities is not None:
        new = new.join(entities.select("name", "type"), ["name", "type"], "left_anti")
    ts = F.localtimestamp() if created_at is None else F.lit(created_at).cast("timestamp_ntz")
    return new.select(entity_id(F.col("name"), F.col("type")).alias("id"), "name", "type",
                      ts.alias("created_at"))


def mention_id():
    return F.xxhash64("doc_id", "page_num", "type", "start", "name")


def load_mentions(mentions: DataFrame, created_at=None) -> DataFrame:
    """D3: mention rows with their entity id. An entity's id is a hash of its
    name and type, so no row has to meet the entity table."""
    ts = F.localtimestamp() if created_at is None else F.lit(created_at).cast("timestamp_ntz")
    return mentions.select(
        mention_id().alias("id"), entity_id(F.col("name"), F.col("type")).alias("entity_id"),
        "doc_id", "page_num", "context", ts.alias("created_at"))


def first_per_filename(candidates: DataFrame) -> DataFrame:
    """One candidate per file name: the first in (corpus, doc_id) order, as a
    run that walks corpora in order would insert it. A partial ``min_by``
    aggregate, so a name repeated everywhere is not sorted in one task."""
    cols = candidates.columns
    return (candidates.groupBy("filename")
            .agg(F.min_by(F.struct(*cols), F.struct("corpus", "doc_id")).alias("_c"))
            .select("_c.*"))


def upsert_documents(candidates: DataFrame, documents: DataFrame | None = None,
                     created_at=None, dedupe: bool = True) -> DataFrame:
    """One row per new filename (first corpus wins), insert-or-ignore.
    ``dedupe=False`` when the candidates are already one per file name."""
    c = first_per_filename(candidates) if dedupe else candidates
    if documents is not None:
        c = c.join(documents.select("filename"), "filename", "left_anti")
    ts = F.localtimestamp() if created_at is None else F.lit(created_at).cast("timestamp_ntz")
    return c.select(
        F.col("doc_id").alias("id"), "corpus", "filename",
        F.lit(None).cast("string").alias("source_url"), "file_path",
        F.col("page_count").cast("int").alias("page_count"),
        F.lit(None).cast("string").alias("date_filed"), ts.alias("created_at"),
        F.lit(False).alias("is_scanned"))


def ingest_status(candidates: DataFrame, documents: DataFrame, first_pages: DataFrame,
                  mention_counts: DataFrame) -> DataFrame:
    """Status per candidate file.

    ``candidates(doc_id, corpus, filename, page_count, readable)``;
    ``first_pages(doc_id, text)``; ``mention_counts(doc_id, mentions)``.
    skipped: filename already loaded; scanned: first page < 50 characters
    (reachable here, unlike the reference, see the survey); empty: no pages;
    error: unreadable; otherwise ok with pages and mentions.
    """
    loaded = documents.select("filename").distinct().withColumn("_loaded", F.lit(True))
    # a repeated file name among the candidates: all but the first are skipped
    firsts = first_per_filename(candidates.select("doc_id", "corpus", "filename")) \
        .select("doc_id", F.lit(True).alias("_first"))
    candidates = candidates.join(firsts, "doc_id", "left")
    fp = first_pages.select("doc_id", F.length("text").alias("_first_len"))
    mc = mention_counts.select("doc_id", "mentions")
    j = (candidates.join(loaded, "filename", "left").join(fp, "doc_id", "left")
         .join(mc, "doc_id", "left"))
    status = (F.when(F.col("_loaded") | F.col("_first").isNull(), F.lit("skipped"))
              .when(~F.coalesce(F.col("readable"), F.lit(True)), F.lit("error"))
              .when(F.coalesce(F.col("page_count"), F.lit(0)) == 0, F.lit("empty"))
              .when(F.coalesce(F.col("_first_len"), F.lit(0)) < S.SCANNED_BELOW, F.lit("scanned"))
              .otherwise(F.lit("ok")))
    return j.select("doc_id", "corpus", "filename", status.alias("status"),
                    F.when(status == "ok", F.col("page_count")).alias("pages"),
                    F.when(status == "ok", F.coalesce("mentions", F.lit(0))).cast("long").alias("mentions"))


def run_release(status: DataFrame, corpora: DataFrame, run_time: str,
                mentions: DataFrame | None = None) -> DataFrame:
    """One release row per corpus of the run, including corpora that added
    nothing. ``entities_found`` counts mentions, as the reference does; with
    ``mentions(doc_id, name, type)`` of the run, ``distinct_entities`` adds
    the number a reader would expect (distinct (name, type) per corpus,
    counted by a two-level aggregate instead of a distinct expand)."""
    ok = status.filter(F.col("status") == "ok")
    per = ok.groupBy("corpus").agg(F.count(F.lit(1)).alias("docs_added"),
                                   F.sum("mentions").alias("entities_found"))
    rt = F.lit(run_time).cast("timestamp_ntz")
    out = corpora.select("corpus").distinct().join(per, "corpus", "left")
    cols = ["corpus", rt.alias("run_date"),
            F.coalesce("docs_added", F.lit(0)).cast("long").alias("docs_added"),
            F.coalesce("entities_found", F.lit(0)).cast("long").alias("entities_found")]
    if mentions is not None:
        pairs = (mentions.join(ok.select("doc_id", "corpus"), "doc_id")
                 .groupBy("corpus", "name", "type").agg(F.lit(1).alias("_one")))
        de = pairs.groupBy("corpus").agg(F.count(F.lit(1)).alias("distinct_entities"))
        out = out.join(de, "corpus", "left")
        cols.append(F.coalesce("distinct_entities", F.lit(0)).cast("long").alias("distinct_entities"))
    cols.append(F.concat(F.lit("Ingestion run "), F.date_format(rt, "yyyy-MM-dd HH:mm")).alias("notes"))
    return out.select(*cols)


def run_totals(status: DataFrame, elapsed_seconds: float | None = None) -> DataFrame:
    """Totals of the run. Scanned and empty files are counted nowhere in
    the reference; they get their own columns here. ``elapsed_seconds`` is the
    run's wall-clock time, for the caller that ran it to pass."""
    s = F.col("status")
    out = status.agg(
        F.count_if(s == "ok").alias("total_docs"),
        F.count_if(s == "skipped").alias("skipped"),
        F.count_if(s == "error").alias("errors"),
        F.count_if(s == "scanned").alias("scanned"),
        F.count_if(s == "empty").alias("empty"),
    )
    return out if elapsed_seconds is None else out.withColumn("elapsed_seconds", F.lit(float(elapsed_seconds)))


def integrity_audit(documents: DataFrame, entities: DataFrame, mentions: DataFrame,
                    redactions: DataFrame, releases: DataFrame | None = None,
                    raw_docs: DataFrame | None = None) -> DataFrame:
    """The store's key rules as violation counts (all 0 when clean).

    One row per rule; each is a grouped count or an anti join, all
    distributed (no collect). A duplicate hash id shows two keys that collide.
    The rules for release ids and raw-document keys (doc_id, block) apply where
    those tables are given."""

    def dup(df, keys, rule):
        return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("violations"))
                .select(F.lit(rule).alias("rule"), "violations"))

    def orphan(child, key, parent, pkey, rule):
        o = child.select(F.col(key).alias("_k")).join(
            parent.select(F.col(pkey).alias("_k")), "_k", "left_anti")
        return o.agg(F.count(F.lit(1)).cast("long").alias("violations")) \
            .select(F.lit(rule).alias("rule"), "violations")

    parts = [
        dup(documents, ["id"], "documents.id unique"),
        dup(documents, ["filename"], "documents.filename unique"),
        dup(entities, ["id"], "entities.id unique"),
        dup(entities, ["name", "type"], "entities.(name,type) unique"),
        dup(mentions, ["id"], "mentions.id unique"),
        dup(redactions, ["id"], "redactions.id unique"),
        *([dup(releases, ["id"], "releases.id unique")] if releases is not None else []),
        *([dup(raw_docs, ["doc_id", "block"], "raw_docs.(doc_id,block) unique"),
           orphan(raw_docs, "doc_id", documents, "id", "raw_docs.doc_id -> documents")] if raw_docs is not None else []),
        orphan(mentions, "entity_id", entities, "id", "mentions.entity_id -> entities"),
        orphan(mentions, "doc_id", documents, "id", "mentions.doc_id -> documents"),
        orphan(redactions, "doc_id", documents, "id", "redactions.doc_id -> documents"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def release_log(documents: DataFrame, mentions: DataFrame) -> DataFrame:
    """A run log derived from loaded tables: one run per (corpus, day of
    ``created_at``). Mentions are counted per document before the join."""
    mc = mentions.groupBy("doc_id").agg(F.count(F.lit(1)).alias("m"))
    d = documents.select(F.col("id").alias("doc_id"), "corpus",
                         # the day, zone-less (date_trunc would return a session-zone timestamp)
                         F.to_date("created_at").cast("timestamp_ntz").alias("run_date"))
    j = d.join(mc, "doc_id", "left")
    per = j.groupBy("corpus", "run_date").agg(
        F.count(F.lit(1)).cast("long").alias("docs_added"),
        F.coalesce(F.sum("m"), F.lit(0)).cast("long").alias("entities_found"))
    # ids grow with time, and within a day in corpus order (the order a run
    # processes its corpora); the window groups are the corpora of one day.
    seq = F.row_number().over(Window.partitionBy("run_date").orderBy("corpus"))
    return per.select(
        # days since the epoch of the (day-truncated, zone-less) run date: the
        # id does not depend on the session time zone
        (F.unix_date(F.to_date("run_date")).cast("long") * 86400 * 1000 + seq).alias("id"),
        "corpus", "run_date", "docs_added",
        "entities_found",
        F.concat(F.lit("Ingestion run "), F.date_format("run_date", "yyyy-MM-dd HH:mm")).alias("notes"))


def ingest_batch(files: DataFrame, pages: DataFrame, loaded_documents: DataFrame,
                 loaded_entities: DataFrame, run_time: str, extract=None,
                 shapes: DataFrame | None = None) -> dict[str, DataFrame]:
    """The whole load run (D1-D7 and the raw-document, page-index and
    redaction rows that belong to it).

    ``files(doc_id, corpus, filename, file_path, page_count)``;
    ``pages(doc_id, page_num, text)`` as extracted; ``shapes`` the page shapes
    of P5-P7, if any; ``extract(pages) -> mentions(doc_id, page_num, type, name,
    start, context)`` (default: the pattern extractor). Returns the rows to
    append to every table plus the per-file status, the release rows and the
    run totals.

    Loaded files are skipped before their pages are read. The mentions of the
    run are extracted once, into the shared scratch folder, and so are its
    fresh files and its pages; every output is derived from these three. Where
    there are shapes, the page records with them are written in place of the pages.
    """
    from quarry.functions.scratch import materialize
    from quarry.operators.mentions import extract_mentions
    from quarry.operators.pages import first_pages, nest_pages, page_records, text_based_filter
    from quarry.operators.search import index_pages
    extract = extract or extract_mentions
    unseen = skip_ingested(files, loaded_documents)                          # D1
    text_based = text_based_filter(unseen, pages)                            # P4
    fresh = materialize(first_per_filename(text_based), "run-files")
    new_docs = upsert_documents(fresh, None, run_time, dedupe=False)         # D4
    new_pages = pages.join(fresh.select("doc_id"), "doc_id", "left_semi")
    if shapes is None:
        new_pages = materialize(new_pages, "run-pages")  # the texts meet the files once
    mentions = materialize(extract(new_pages), "run-mentions")               # M1-M4
    new_entities = upsert_entities(mentions, loaded_entities, run_time)      # D2
    new_mentions = load_mentions(mentions, run_time)                         # D3
    counts = mentions.groupBy("doc_id").agg(F.count(F.lit(1)).alias("mentions"))
    # files of the run: text-based ones, and the ones loaded before (skipped unread)
    known = files.join(loaded_documents.select("filename").distinct(), "filename", "left_semi")
    candidates = text_based.unionByName(known).withColumn("readable", F.lit(True))
    status = ingest_status(candidates, loaded_documents, first_pages(new_pages), counts)  # D5
    releases = run_release(status, files.select("corpus"), run_time, mentions)  # D6
    records = page_records(new_pages, shapes)                                # raw documents, page index, redactions
    if shapes is not None:
        records = materialize(records, "run-records")
    redactions = (records.where("redaction_count > 0")
                  .select(F.xxhash64("doc_id", "page_num").alias("id"), "doc_id", "page_num", "redaction_count",
                          F.col("estimated_chars_redacted").alias("estimated_chars")))
    return {"status": status, "documents": new_docs, "entities": new_entities,
            "mentions": new_mentions, "releases": releases, "totals": run_totals(status),
            "raw_docs": nest_pages(records, new_docs),
            "page_index": index_pages(records).select("doc_id", "page_num", "text"),
            "redactions": redactions}
