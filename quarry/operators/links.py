"""Link harvest over fetched index pages.

Fetching is outside Spark; the input is a table of fetched pages
``(source, page_id, url, html)``. Pages are read by an Arrow-batched function
(``functions.anchors``), a narrow step in time linear in the page.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.anchors import hrefs
from quarry.functions.text import url_filename

PAGES_AT_ONCE = 64  # pages that are Python objects at one time


def extract_links(pages: DataFrame, needle: str | None = None) -> DataFrame:
    """L1: every ``<a href>`` of a page in document order (pos from 0); with
    ``needle``, only hrefs whose lower-cased text contains it (the reference
    uses ``.pdf``). A null page has no links; the page's other columns are carried along."""
    kept = [f for f in pages.schema.fields if f.name not in ("html", "pos", "href")]
    schema = T.StructType([*kept, T.StructField("pos", T.IntegerType()), T.StructField("href", T.StringType())])
    wanted = needle.lower() if needle else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = batch.slice(start, PAGES_AT_ONCE)
                rows, places, found = [], [], []
                for i, page in enumerate(part.column("html").to_pylist()):
                    for pos, href in enumerate(hrefs(page)):
                        if wanted is None or wanted in href.lower():
                            rows.append(i)
                            places.append(pos)
                            found.append(href)
                taken = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays([*(part.column(f.name).take(taken) for f in kept),
                                                  pa.array(places, pa.int32()), pa.array(found, pa.string())], schema.names)

    return pages.select(*[f.name for f in kept], "html").mapInArrow(run, schema)


def absolutize_links(links: DataFrame, base: str) -> DataFrame:
    """L2: keep hrefs that start with ``http``, else prefix the site base
    (plain concatenation, as the reference does)."""
    return links.withColumn("link", F.when(F.col("href").startswith("http"), F.col("href"))
                            .otherwise(F.concat(F.lit(base), F.col("href"))))


def index_page_links(links: DataFrame, contains: str, excludes: str | None = None) -> DataFrame:
    """L3: distinct links containing one marker and not another, in first-seen
    order (``first_page``, ``first_pos``)."""
    f = F.col("link").contains(contains)
    if excludes:
        f = f & ~F.col("link").contains(excludes)
    return (links.filter(f).groupBy("link")
            .agg(F.min(F.struct("page_id", "pos")).alias("_f"))
            .select("link", F.col("_f.page_id").alias("first_page"), F.col("_f.pos").alias("first_pos")))


def with_filenames(links: DataFrame, decode: bool = False) -> DataFrame:
    """L4: the file name a link would be saved under."""
    return links.withColumn("filename", url_filename(F.col("link"), decode))


def plan_downloads(links: DataFrame, manifest: DataFrame | None = None,
                   present: DataFrame | None = None) -> DataFrame:
    """Per link, ``fetch`` or ``skip``: skip when the file name is in the
    manifest, already on disk, or an earlier link (page order, then position)
    has the same file name in this run. ``manifest`` and ``present`` hold a
    ``filename`` column. ``links`` is read twice and small next to its pages:
    pass a stored table (``scratch.materialize``), or the pages are read twice.

    The first occurrence per name is a partial (map-side) ``min`` aggregate
    joined back on the name: a name on every page costs one row per map task
    in the shuffle, and the join's hot key is split by AQE, where a window
    over the name would sort all copies in one task.
    """
    first = links.groupBy("filename").agg(F.min(F.struct("page_id", "pos")).alias("_f"))
    l = links.join(first, "filename")
    known = None
    for t in (manifest, present):
        if t is not None:
            k = t.select("filename").distinct()
            known = k if known is None else known.union(k).distinct()
    if known is not None:
        l = l.join(known.withColumn("_known", F.lit(True)), "filename", "left")
    else:
        l = l.withColumn("_known", F.lit(None).cast("boolean"))
    is_first = (F.col("page_id") == F.col("_f.page_id")) & (F.col("pos") == F.col("_f.pos"))
    return l.withColumn("status", F.when(F.col("_known").isNull() & is_first, F.lit("fetch"))
                        .otherwise(F.lit("skip"))).drop("_known", "_f")


def harvest_counts(plan: DataFrame) -> DataFrame:
    """Found / to fetch / skipped per source."""
    return plan.groupBy("source").agg(
        F.count(F.lit(1)).alias("found"),
        F.count_if(F.col("status") == "fetch").alias("to_fetch"),
        F.count_if(F.col("status") == "skip").alias("skipped"))


def manifest_rows(plan: DataFrame, corpus: str, fetched_on=None) -> DataFrame:
    """I3 rows for the fetched links: (corpus, filename, url, date, 0)."""
    d = F.current_date() if fetched_on is None else F.lit(fetched_on).cast("date")
    return plan.filter(F.col("status") == "fetch").select(
        F.lit(corpus).alias("corpus"), "filename", F.col("link").alias("url"), d.alias("fetched"),
        F.lit(0).alias("page_count"))
