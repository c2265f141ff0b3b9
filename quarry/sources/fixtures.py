"""Views that fill the star schema and the text tables from the driver tables.

Each view is a plain projection / explode over one driver table (one join for
``page_count`` of the star documents), so Catalyst still prunes columns and
pushes filters down to the Parquet scan. The same views are written as DuckDB
SQL in :mod:`quarry.plans.oracle` for the independent check.

STAR: orders -> documents, part -> entities, lineitem -> mentions,
      lineitem -> page_shapes and redactions, supplier keys -> co-mentions.
TEXT: documents -> text documents, pages of 2,000 characters, raw_docs.
VECTOR: embeddings -> chunks with metadata.
LINK: pages(page_id, url, html) -> fetched pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.partitioning import spread

PAGE_CHARS = 2000
TEXT_RUN_TIME = "2025-03-18 09:30:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------------------
# STAR fixture
# ---------------------------------------------------------------------------

def star_documents(spark: SparkSession, sf_dir: str, with_page_count: bool = False) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    docs = o.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderpriority").alias("corpus"),
        F.concat(F.lit("order-"), F.col("o_orderkey"), F.lit(".pdf")).alias("filename"),
        F.lit(None).cast("string").alias("source_url"),
        F.concat(F.lit("/data/"), F.col("o_orderpriority"), F.lit("/order-"),
                 F.col("o_orderkey"), F.lit(".pdf")).alias("file_path"),
        F.lit(None).cast("string").alias("date_filed"),
        F.col("o_orderdate").alias("created_at"),
        F.lit(False).alias("is_scanned"),
        F.col("o_orderkey").alias("_ok"),
    )
    if with_page_count:
        # pages of an order = its line items (page_num = l_linenumber)
        pc = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
              .agg(F.count(F.lit(1)).cast("int").alias("page_count")))
        docs = docs.join(pc, docs["_ok"] == pc["l_orderkey"], "left") \
            .withColumn("page_count", F.coalesce("page_count", F.lit(0)))
    else:
        docs = docs.withColumn("page_count", F.lit(None).cast("int"))
    return docs.select("id", "corpus", "filename", "source_url", "file_path", "page_count",
                       "date_filed", "created_at", "is_scanned")


def star_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("id"),
        F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey")).alias("name"),
        F.col("p_type").alias("type"),
    )


def star_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
        F.col("l_partkey").alias("entity_id"),
        F.col("l_orderkey").cast("string").alias("doc_id"),
        F.col("l_linenumber").alias("page_num"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("context"),
    )


def star_supplier_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions whose entity is the supplier (100 values at sf0.01): the
    co-occurrence fixture."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("entity_id"),
        F.col("l_orderkey").cast("string").alias("doc_id"),
        F.col("l_linenumber").alias("page_num"),
    )


def star_supplier_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                    F.lit("ORG").alias("type"))


def star_page_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    black = F.col("l_returnflag") == "R"
    return li.select(
        F.col("l_orderkey").cast("string").alias("doc_id"),
        F.col("l_linenumber").alias("page_num"),
        F.when(F.col("l_linestatus") == "O", F.lit("annot")).otherwise(F.lit("drawing")).alias("kind"),
        F.when(black, F.lit(12)).otherwise(F.lit(4)).alias("annot_type"),
        F.when(black, F.array(*[F.lit(0.0)] * 3)).otherwise(F.array(*[F.lit(1.0)] * 3)).alias("fill"),
        F.col("l_quantity").alias("width"),
        (F.col("l_discount") * 200).alias("height"),
    )


def star_redactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Redaction rows: drawing rule applied to every returned line item."""
    li = table(spark, sf_dir, "lineitem")
    w = F.col("l_quantity")
    h = F.col("l_discount") * 200
    return (li.filter((F.col("l_returnflag") == "R") & (w > 20) & (h > 8))
            .groupBy("l_orderkey", "l_linenumber")
            .agg(F.count(F.lit(1)).cast("int").alias("redaction_count"),
                 F.sum(((w / 7) * (h / 12)).cast("int")).cast("int").alias("estimated_chars"))
            .select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
                    F.col("l_orderkey").cast("string").alias("doc_id"),
                    F.col("l_linenumber").alias("page_num"),
                    "redaction_count", "estimated_chars"))


def star_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run log derived from the star tables: one run per (corpus, order day);
    docs_added = documents created that day, entities_found = their mentions."""
    from quarry.operators.load import release_log
    return release_log(star_documents(spark, sf_dir), star_mentions(spark, sf_dir))


# ---------------------------------------------------------------------------
# TEXT fixture
# ---------------------------------------------------------------------------

def text_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("source").alias("corpus"),
        F.concat(F.lit("doc-"), F.col("doc_id"), F.lit(".pdf")).alias("filename"),
        F.lit(None).cast("string").alias("source_url"),
        F.concat(F.lit("/data/"), F.col("source"), F.lit("/doc-"), F.col("doc_id"),
                 F.lit(".pdf")).alias("file_path"),
        # n_chars is the text's length, so the document side never reads the text
        F.ceil(F.col("n_chars") / PAGE_CHARS).cast("int").alias("page_count"),
        F.lit(None).cast("string").alias("date_filed"),
        F.lit(TEXT_RUN_TIME).cast("timestamp_ntz").alias("created_at"),
        F.lit(False).alias("is_scanned"),
    )


def text_pages(spark: SparkSession, sf_dir: str, with_document: bool = False) -> DataFrame:
    """Extracted pages: ``substring(text, i*2000+1, 2000)``, page_num = i+1.
    Text is as extracted (not yet stripped). ``with_document`` adds the
    document attributes the load path carries (corpus, filename, file_path),
    derived from the same scan rather than joined back."""
    cols = ["doc_id", "text"] + (["source"] if with_document else [])
    d = spread(table(spark, sf_dir, "documents").select(*cols), "doc_id")
    # one regex pass cuts the text; an empty text is one empty page
    runs = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("(?s).{1,%d}" % PAGE_CHARS), 0)
    pages = F.when(F.size(runs) == 0, F.array(F.col("text"))).otherwise(runs)
    extra = []
    if with_document:
        extra = [F.col("source").alias("corpus"),
                 F.concat(F.lit("doc-"), F.col("doc_id"), F.lit(".pdf")).alias("filename"),
                 F.concat(F.lit("/data/"), F.col("source"), F.lit("/doc-"), F.col("doc_id"),
                          F.lit(".pdf")).alias("file_path")]
    return (d.select(F.col("doc_id").cast("string").alias("doc_id"), *extra, F.posexplode(pages).alias("i", "text"))
            .select("doc_id", (F.col("i") + 1).alias("page_num"), "text",
                    *[c for c in ("corpus", "filename", "file_path") if with_document]))


def text_corpus_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with the document attributes the load path carries."""
    return text_pages(spark, sf_dir, with_document=True)


def questions_from_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions = the benchmark passages (they also occur inside documents)."""
    b = table(spark, sf_dir, "benchmark")
    return b.select(F.col("item_id").alias("question_id"), F.col("text").alias("question"),
                    F.lit(None).cast("string").alias("corpus"))


# ---------------------------------------------------------------------------
# VECTOR fixture
# ---------------------------------------------------------------------------

def vector_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").cast("string").alias("chunk_id"),
        F.concat(F.lit("vector "), F.col("vec_id")).alias("text"),
        F.col("embedding"),
        F.struct(F.col("vec_id").cast("string").alias("doc_id"),
                 F.col("label").cast("string").alias("corpus"),
                 F.concat(F.lit("vec-"), F.col("vec_id"), F.lit(".pdf")).alias("filename"),
                 F.lit(1).alias("page_num")).alias("metadata"),
    )


def label_centroid_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question vector per label: the mean of that label's embeddings.
    Computed as a distributed aggregate over (label, dimension)."""
    e = table(spark, sf_dir, "embeddings")
    per_dim = (e.select("label", F.posexplode("embedding").alias("d", "x"))
               .groupBy("label", "d").agg(F.avg("x").alias("x")))
    return (per_dim.groupBy("label")
            .agg(F.array_sort(F.collect_list(F.struct("d", "x"))).alias("v"))
            .select(F.col("label").cast("long").alias("question_id"),
                    F.col("v.x").cast("array<float>").alias("embedding"),
                    F.lit(None).cast("string").alias("corpus")))


# ---------------------------------------------------------------------------
# LINK fixture
# ---------------------------------------------------------------------------

def fetched_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spread(table(spark, sf_dir, "pages"), "page_id")
    return p.select(F.lit("web").alias("source"), F.col("page_id"), F.col("url"), F.col("html"))


def benchmark_names(spark: SparkSession, sf: str) -> DataFrame:
    """A dictionary (name, type): the first words of every benchmark passage, alone and in runs, some of them
    under two types and some under one that is not kept."""
    w = F.split("text", " ")
    part = lambda a, n, kind: F.struct(F.array_join(F.slice(w, a, n), " ").alias("name"), F.lit(kind).alias("type"))
    names = F.array(part(1, 1, "GPE"), part(1, 2, "PERSON"), part(2, 2, "PERSON"), part(2, 2, "ORG"), part(1, 3, "ORG"),
                    part(3, 4, "EVENT"), part(2, 1, "EMAIL"))
    return table(spark, sf, "benchmark").select(F.explode(names).alias("n")).select("n.*")
