"""Registered vector, retrieval and answer queries (V4-V15) and SQL twins.

VECTOR fixture: every embedding is a chunk (corpus = its label); the
questions are the label centroids, computed by Spark from the same table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import answers as A
from quarry.operators import chunks as C
from quarry.operators import vectors as V
from quarry import schemas as S
from quarry.operators.search import fts_tokens
from quarry.plans.oracle import TEXT_PAGES, with_
from quarry.plans.text_queries import _CHUNKS, _STRIPPED
from quarry.sources import fixtures as fx

Q: dict = {}
SQL: dict = {}


def register(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def _questions(spark, sf, filtered=False):
    q = fx.label_centroid_questions(spark, sf)
    if filtered:
        q = q.withColumn("corpus", F.col("question_id").cast("string"))
    return q.withColumn("question", F.concat(F.lit("Which passages are closest to label "),
                                             F.col("question_id").cast("string"), F.lit("?")))


_BASE = """
WITH emb AS (
  SELECT CAST(vec_id AS VARCHAR) AS chunk_id, embedding, CAST(label AS VARCHAR) AS corpus,
         'vector ' || vec_id AS text, CAST(vec_id AS VARCHAR) AS doc_id,
         'vec-' || vec_id || '.pdf' AS filename, 1 AS page_num
  FROM embeddings),
dims AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS d FROM embeddings),
cent AS (SELECT label, d, avg(x) AS x FROM dims GROUP BY label, d),
q AS (SELECT CAST(label AS BIGINT) AS question_id, CAST(list(CAST(x AS FLOAT) ORDER BY d) AS DOUBLE[]) AS v,
             CAST(label AS VARCHAR) AS qcorpus,
             'Which passages are closest to label ' || label || '?' AS question
      FROM cent GROUP BY label),
dist AS (
  SELECT q.question_id, e.chunk_id,
         1 - list_dot_product(q.v, CAST(e.embedding AS DOUBLE[]))
             / (sqrt(list_dot_product(q.v, q.v))
                * sqrt(list_dot_product(CAST(e.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[]))))
           AS distance
  FROM q JOIN emb e ON {join}),
top AS (
  SELECT question_id, CAST(rank AS INTEGER) AS rank, chunk_id, round(greatest(0, distance), 6) AS distance
  FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY distance, chunk_id) AS rank
        FROM dist) WHERE rank <= 5),
hits AS (SELECT t.*, e.text, e.doc_id, e.corpus, e.filename, e.page_num
         FROM top t JOIN emb e ON e.chunk_id = t.chunk_id)
"""
_ALL = _BASE.replace("{join}", "true")
_FILTERED = _BASE.replace("{join}", "e.corpus = q.qcorpus")


@register("vector_topk", _ALL + "SELECT question_id, rank, chunk_id, distance FROM top")
def vector_topk(spark, sf):
    """V6: exact cosine top-5 of each label centroid over all embeddings."""
    return V.vector_topk(fx.vector_chunks(spark, sf), _questions(spark, sf))


@register("vector_filter", _FILTERED + "SELECT question_id, rank, chunk_id, distance FROM top")
def vector_filter(spark, sf):
    """V8: the same, each question restricted to its own corpus (label)."""
    return V.vector_topk(fx.vector_chunks(spark, sf), _questions(spark, sf, filtered=True))


@register("retrieve", _ALL + """
SELECT question_id, rank, chunk_id, text, doc_id, corpus, filename, page_num, distance FROM hits""")
def retrieve(spark, sf):
    """V9 (+V5): hits with text and metadata."""
    h = V.retrieve(fx.vector_chunks(spark, sf), _questions(spark, sf))
    return h.select("question_id", "rank", "chunk_id", "text", "metadata.doc_id", "metadata.corpus",
                    "metadata.filename", "metadata.page_num", "distance")


@register("context_block", _ALL + """
SELECT question_id,
       string_agg(chr(10) || '[Source ' || rank || ': ' || filename || ', page ' || page_num || ']'
                  || chr(10) || text || chr(10), '' ORDER BY rank) AS context
FROM hits GROUP BY question_id""")
def context_block(spark, sf):
    """V10."""
    return A.context_blocks(V.retrieve(fx.vector_chunks(spark, sf), _questions(spark, sf)))


_PROMPT_SQL = ("'Answer the question using ONLY the provided source documents.' || chr(10) || "
               "'For every claim you make, cite the source number in brackets like [Source 1].' || chr(10) || "
               "'If the answer is not in the documents, say \"This information was not found in the "
               "available documents.\"' || chr(10) || 'Do not use any outside knowledge.' || chr(10) || "
               "chr(10) || 'Question: ' || q.question || chr(10) || chr(10) || 'Sources:' || chr(10) || "
               "c.context || chr(10) || chr(10) || 'Answer:'")


@register("prompt_text", _ALL + f""",
ctx AS (SELECT question_id,
               string_agg(chr(10) || '[Source ' || rank || ': ' || filename || ', page ' || page_num || ']'
                          || chr(10) || text || chr(10), '' ORDER BY rank) AS context
        FROM hits GROUP BY question_id)
SELECT q.question_id, {_PROMPT_SQL} AS prompt FROM q JOIN ctx c ON c.question_id = q.question_id""")
def prompt_text(spark, sf):
    """V11."""
    q = _questions(spark, sf)
    ctx = A.context_blocks(V.retrieve(fx.vector_chunks(spark, sf), q))
    return A.prompt_text(q, ctx)


@register("citations", _ALL + """
SELECT question_id, CAST(rank AS INTEGER) AS rank, filename, page_num, corpus, doc_id,
       substring(text, 1, 200) AS excerpt
FROM hits""")
def citations(spark, sf):
    """V12, one row per citation (rank = position in the list)."""
    c = A.citations(V.retrieve(fx.vector_chunks(spark, sf), _questions(spark, sf)))
    return c.select("question_id", F.posexplode("citations").alias("rank", "c")).select(
        "question_id", (F.col("rank") + 1).cast("int").alias("rank"), "c.filename", "c.page_num",
        "c.corpus", "c.doc_id", "c.excerpt")


@register("vector_topk_lsh", """
SELECT DISTINCT CAST(label AS BIGINT) AS question_id, true AS most_found, true AS pruned, true AS exact_distances
FROM embeddings""")
def vector_topk_lsh(spark, sf):
    """V7 against V6: per question, whether the approximate top 5 hold at least
    3 of the exact ones, whether its candidates are under half of all chunks, and
    whether the distances they share are equal."""
    chunks, qs = fx.vector_chunks(spark, sf), _questions(spark, sf)
    near = V.vector_topk_lsh(chunks, qs).select("question_id", "chunk_id", F.col("distance").alias("near"))
    both = V.vector_topk(chunks, qs).join(near, ["question_id", "chunk_id"]).groupBy("question_id").agg(
        (F.count(F.lit(1)) >= 3).alias("most_found"), F.bool_and(F.abs(F.col("distance") - F.col("near")) < 1e-5).alias("exact_distances"))
    share = V.lsh_candidates(chunks, qs).groupBy("question_id").agg(
        (F.count(F.lit(1)) < 0.5 * chunks.agg(F.count(F.lit(1))).scalar()).alias("pruned"))
    return both.join(share, "question_id").select("question_id", "most_found", "pruned", "exact_distances")


@register("vector_index", """
SELECT count(*) AS stored, true AS recall_reached, true AS distances_possible, true AS exact_with_all_cells FROM embeddings""")
def vector_index(spark, sf):
    """V7 on a written index: all chunks stored in two segments, the label centroids and every hundredth chunk as
    questions against V6: whether nine in ten of the exact top 5 are found, whether no result is nearer than the
    exact one of its rank, and whether reading all cells gives the exact distances."""
    import uuid

    from quarry.operators import vector_index as VI
    from quarry.session import checkpoint_dir

    chunks = fx.vector_chunks(spark, sf)
    path = f"{checkpoint_dir(spark).rstrip('/')}/vector-index-{uuid.uuid4().hex}"
    late = F.pmod(F.xxhash64("chunk_id"), F.lit(5)) == 0
    VI.build_index(chunks.where(~late), path, questions=_questions(spark, sf))
    VI.append_chunks(chunks.where(late), path, "late")
    index = VI.open_index(spark, path)
    picked = chunks.where(F.pmod(F.xxhash64("chunk_id"), F.lit(100)) == 0).select(F.xxhash64("chunk_id").alias("question_id"), "embedding")
    qs = _questions(spark, sf).select("question_id", "embedding").unionByName(picked)
    exact = V.vector_topk(chunks, qs).select("question_id", "rank", F.col("distance").alias("exact"))
    full = VI.search(index, qs, probes=len(index.centres)).select("question_id", "rank", F.col("distance").alias("full"))
    # equal vectors are interchangeable: what counts is how near the found ones are
    last = exact.groupBy("question_id").agg(F.max("exact").alias("last"))
    near = (VI.search(index, qs).join(last, "question_id").where(F.col("distance") <= F.col("last") + 1e-5)
            .select("question_id", "rank", F.col("distance").alias("near")))
    return (exact.join(full, ["question_id", "rank"], "left").join(near, ["question_id", "rank"], "left").agg(
        F.lit(index.vectors.agg(F.count(F.lit(1))).first()[0]).cast("long").alias("stored"),
        (F.count("near") >= 0.9 * F.count(F.lit(1))).alias("recall_reached"),
        F.bool_and(F.coalesce(F.col("near") >= F.col("exact") - 1e-5, F.lit(True))).alias("distances_possible"),
        F.bool_and(F.coalesce(F.abs(F.col("full") - F.col("exact")) < 1e-5, F.lit(False))).alias("exact_with_all_cells")))


class LetterCounts:
    """A model that counts two letters and all characters, and cannot read texts of some lengths."""

    def __call__(self, texts):
        if any(len(t) % 97 == 0 for t in texts):
            raise ValueError("unreadable")
        return [[t.count("a"), t.count("e"), len(t)] for t in texts]


@register("embed_with_model", with_(TEXT_PAGES) + """
SELECT doc_id, page_num, length(text) % 97 = 0 AS failed,
       CASE WHEN length(text) % 97 <> 0 THEN length(text) - length(replace(text, 'a', '')) END AS a,
       CASE WHEN length(text) % 97 <> 0 THEN length(text) - length(replace(text, 'e', '')) END AS e,
       CASE WHEN length(text) % 97 <> 0 THEN length(text) END AS n
FROM text_pages""")
def embed_with_model(spark, sf):
    """V4 with a model of the caller's: every page, with the rows that the model cannot read."""
    from quarry.operators.embed import embed_with

    out = embed_with(fx.text_pages(spark, sf), LetterCounts, "letter counts", max_rows=16)
    number = lambda i: F.get("embedding", F.lit(i)).cast("int")
    return out.select("doc_id", "page_num", F.col("error").isNotNull().alias("failed"), number(0).alias("a"), number(1).alias("e"), number(2).alias("n"))


def _text_chunks(spark, sf):
    pages = fx.text_corpus_pages(spark, sf)
    return C.with_metadata(C.chunk_text(pages))


@register("embed_chunks", with_(TEXT_PAGES, _STRIPPED, _CHUNKS) + """,
toks AS (SELECT md5(text) AS text_md5,
                len(list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\\x00-/:-@\\[-`{-\\x7f]+'), lambda x: x <> '')) AS n FROM chunks)
SELECT text_md5, count(*) AS chunks, CAST(1 AS BIGINT) AS embeddings, CAST(max(n) AS INTEGER) AS n_tokens, max(n) > 0 AS unit, 1024 AS dim
FROM toks GROUP BY text_md5""")
def embed_chunks(spark, sf):
    """V4: default embedder (hashing TF, corpus IDF, L2 norm) over all chunks:
    per distinct text its chunks, their distinct embeddings, tokens, and whether
    the embedding has length 1 (it has length 0 without tokens)."""
    emb = V.HashingEmbedder().fit_transform(_text_chunks(spark, sf))
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    return emb.select(F.md5("text").alias("text_md5"), F.xxhash64("embedding").alias("e"), F.size("embedding").alias("dim"),
                      F.size(fts_tokens(F.col("text"))).alias("n"), (F.abs(norm - 1) < 1e-3).alias("u")).groupBy("text_md5").agg(
        F.count(F.lit(1)).alias("chunks"), F.count_distinct("e").alias("embeddings"), F.max("n").alias("n_tokens"),
        F.bool_and("u").alias("unit"), F.max("dim").alias("dim"))


@register("ask_batch", _FILTERED + f""",
ctx AS (SELECT question_id, count(*) AS n, arg_min(filename, rank) AS top_filename,
               string_agg(chr(10) || '[Source ' || rank || ': ' || filename || ', page ' || page_num || ']'
                          || chr(10) || text || chr(10), '' ORDER BY rank) AS context
        FROM hits GROUP BY question_id)
SELECT q.question_id, CAST(c.n AS INTEGER) AS n_citations, {_PROMPT_SQL} AS prompt, CAST(NULL AS VARCHAR) AS answer, c.top_filename
FROM q JOIN ctx c ON c.question_id = q.question_id
UNION ALL
SELECT question_id + 1000, 0, NULL, '{S.NO_HITS_ANSWER.replace("'", "''")}', NULL FROM q""")
def ask_batch(spark, sf):
    """Every label's question asked in its own corpus, and once more
    in a corpus that has no chunk."""
    qs = _questions(spark, sf, filtered=True)
    qs = qs.unionByName(qs.withColumn("question_id", F.col("question_id") + 1000).withColumn("corpus", F.lit("nowhere")))
    out = A.ask_batch(fx.vector_chunks(spark, sf), qs)
    return out.select("question_id", F.size("citations").alias("n_citations"), "prompt", "answer",
                      F.get("citations", F.lit(0))["filename"].alias("top_filename"))


@register("ask_text_batch")
def ask_text_batch(spark, sf):
    """V14 with the default embedder: the benchmark passages asked against all text chunks."""
    model = V.HashingEmbedder()
    chunks = model.fit_transform(_text_chunks(spark, sf))
    qs = fx.questions_from_benchmark(spark, sf)
    out = A.ask_batch(chunks, qs, embed=lambda q: model.transform(q, text_col="question"))
    return out.select("question_id", F.size("citations").alias("n_citations"),
                      F.length("prompt").alias("prompt_chars"), "answer",
                      F.get("citations", F.lit(0))["filename"].alias("top_filename"))
