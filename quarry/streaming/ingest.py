"""Incremental ingest as Structured Streaming.

Reruns of the reference add only files it has not seen. What has been seen is
the documents table of the store: each micro-batch runs the batch load
(:func:`quarry.operators.load.ingest_batch`), whose anti-join skips loaded
files and whose first-per-name rule settles repeats within the batch. Only
files that got into ``documents`` are remembered, so a file that was rejected
(scanned, short) is tried again when it comes back; repeats are reported as
``skipped``, and every corpus of a batch gets its release row. The stream itself
holds no state beyond the source's log of processed input files.

Every output table is written under ``batch_id=N``. A re-executed batch
overwrites only its own partition and reads "already loaded" from batches
``< N``, so retries after a lost executor or driver neither duplicate nor
lose rows. A batch is read from its files; where documents come twice in it, its rows are stored
in the shared scratch folder, repeats are settled by ids and digests alone, and what is left is stored
for all outputs. With ``index_buckets`` the batch's pages also become a segment of the page
index under the store, committed with the batch's name, so a search finds what was just loaded.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.scratch import materialize
from quarry.operators import page_index
from quarry.operators.load import ingest_batch
from quarry.session import checkpoint_dir

RAW_INPUT = T.StructType([
    T.StructField("doc_id", T.StringType()),
    T.StructField("corpus", T.StringType()),
    T.StructField("filename", T.StringType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("pages", T.ArrayType(T.StructType([
        T.StructField("page_num", T.IntegerType()),
        T.StructField("text", T.StringType())]))),
])

TABLES = ("documents", "entities", "mentions", "releases", "status", "raw_docs", "page_index", "redactions")


def _table(spark: SparkSession, store: str, name: str, before_batch: int | None = None) -> DataFrame:
    """A store table with ``batch_id`` from partition discovery; the empty
    ``batch_id=-1`` partition written at creation carries the schema."""
    df = spark.read.parquet(f"{store}/{name}").filter(F.col("batch_id") >= 0)
    if before_batch is not None:
        df = df.filter(F.col("batch_id") < before_batch)
    return df


def _ensure_tables(spark: SparkSession, store: str, schemas: dict[str, T.StructType]) -> None:
    for name, schema in schemas.items():
        path = f"{store}/{name}"
        if not _exists(spark, path):
            spark.createDataFrame([], schema).coalesce(1).write.parquet(f"{path}/batch_id=-1")


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def _schemas(spark: SparkSession) -> dict[str, T.StructType]:
    """Output schemas of the load DAG, taken from an empty run."""
    empty = spark.createDataFrame([], RAW_INPUT)
    out = _run_batch(spark, empty, None, None, "1970-01-01 00:00:00")
    return {k: out[k].schema for k in TABLES}


def _run_batch(spark, batch: DataFrame, loaded_docs, loaded_entities, run_time, extract=None, shapes=None):
    batch = each_document_once(batch)
    files = batch.select("doc_id", "corpus", "filename", "file_path",
                         F.size("pages").cast("int").alias("page_count"))
    pages = batch.select("doc_id", F.explode("pages").alias("p")).select(
        "doc_id", F.col("p.page_num").alias("page_num"), F.col("p.text").alias("text"))
    if loaded_docs is None:
        loaded_docs = spark.createDataFrame([], "id string, filename string")
    if loaded_entities is None:
        loaded_entities = spark.createDataFrame([], "id long, name string, type string, "
                                                    "created_at timestamp")
    return ingest_batch(files, pages, loaded_docs, loaded_entities, run_time, extract, shapes)


def each_document_once(batch: DataFrame) -> DataFrame:
    """The batch, ready to be read by every output without a join. Its files are fixed, so a batch in which
    no document comes twice (the ids alone tell) is read from them; only another one is written."""
    several = batch.groupBy("doc_id").agg(F.count("*").alias("copies")).where("copies > 1")
    if several.isEmpty():
        return batch
    return one_per_document(materialize(batch.withColumn("_row", F.monotonically_increasing_id()), "batch"))


def one_per_document(stored: DataFrame) -> DataFrame:
    """A document dropped more than once in a batch counts once: the copy with the longer first page, of
    equal ones the one with the greater digest, so that a batch that is executed again chooses alike.
    ``stored`` is a written table whose rows are numbered by ``_row``. Only ids, lengths and digests
    are grouped; the rows that go (usually none) are taken out by number."""
    first = F.coalesce(F.length(F.get("pages", F.lit(0))["text"]), F.lit(-1))
    content = F.xxhash64(F.to_json(F.struct(*[c for c in stored.columns if c != "_row"])))
    keys = stored.select("doc_id", "_row", F.struct(first.alias("first"), content.alias("content"), (-F.col("_row")).alias("row")).alias("key"))
    several = keys.groupBy("doc_id").agg(F.max("key").alias("best"), F.count("*").alias("copies")).where("copies > 1")
    gone = (keys.join(several.select(F.col("doc_id").alias("twice"), "best"), F.col("doc_id").eqNullSafe(F.col("twice")))
            .where("_row <> -best.row").select("_row"))
    return materialize(stored.join(materialize(gone, "repeats"), "_row", "left_anti").drop("_row"), "batch-once")


def stream_ingest(spark: SparkSession, source: str, store: str, name: str = "ingest",
                  checkpoint: str | None = None, extract=None, fmt: str = "parquet",
                  available_now: bool = True, shapes: DataFrame | None = None, index_buckets: int | None = None):
    """T1+T2: start the incremental ingest of ``source`` (files of
    ``RAW_INPUT`` rows) into the tables under ``store``. Returns the
    ``StreamingQuery``; with ``available_now`` it processes what is there and
    stops (call ``awaitTermination()``). ``shapes`` is a static table of page
    shapes, if redactions are wanted; ``index_buckets`` the number of term buckets of
    the page index (``open_store_index``), if one is."""
    shared = checkpoint_dir(spark)       # also where a batch's intermediate tables go
    ckpt = checkpoint or os.path.join(shared, f"{name}-stream")
    _ensure_tables(spark, store, _schemas(spark))
    stream = (spark.readStream.schema(RAW_INPUT).format(fmt)
              .option("maxFilesPerTrigger", 1000).load(source))

    def process(batch: DataFrame, batch_id: int) -> None:
        run_time = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        docs = _table(spark, store, "documents", batch_id).select("id", "filename")
        ents = _table(spark, store, "entities", batch_id).select("id", "name", "type", "created_at")
        out = _run_batch(spark, batch, docs, ents, run_time, extract, shapes)
        for t in TABLES:
            (out[t].withColumn("batch_id", F.lit(batch_id).cast("long")).write
             .mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(f"{store}/{t}"))
        if index_buckets:
            pages = _table(spark, store, "page_index").where(F.col("batch_id") == batch_id).drop("batch_id")
            page_index.append_pages(pages, f"{store}/index", index_buckets, f"batch-{batch_id}")

    w = stream.writeStream.foreachBatch(process).option("checkpointLocation", ckpt) \
        .queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_store(spark: SparkSession, store: str, table: str) -> DataFrame:
    """A table of the store across all batches."""
    return _table(spark, store, table)


def open_store_index(spark: SparkSession, store: str, stem: bool = True):
    """The page index of all committed batches, ready to be searched."""
    return page_index.open_index(spark, f"{store}/index", stem)


def raw_input_from_pages(pages: DataFrame, files: DataFrame) -> DataFrame:
    """RAW_INPUT rows (one per file, pages nested in page order) from a page
    table and a file table: the shape a document extractor would drop."""
    per = pages.groupBy("doc_id").agg(F.array_sort(F.collect_list(
        F.struct(F.col("page_num").cast("int").alias("page_num"), "text"))).alias("pages"))
    return files.select("doc_id", "corpus", "filename", "file_path").join(per, "doc_id")
