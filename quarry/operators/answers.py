"""Cited context, prompts and answer records for a batch of questions.

The remote language-model call is outside Spark; the job's output is the
prompt of every question plus its citations. All per-question work is a
group of at most k hits, assembled with built-in array functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.functions.scratch import materialize
from quarry.operators.vectors import retrieve


def _piece():
    return F.concat(F.format_string(S.SOURCE_HEADER, F.col("rank"), F.col("metadata.filename"),
                                    F.col("metadata.page_num")),
                    F.col("text"), F.lit("\n"))


def _citation():
    return F.struct(F.col("metadata.filename").alias("filename"),
                    F.col("metadata.page_num").alias("page_num"), F.col("metadata.corpus").alias("corpus"),
                    F.col("metadata.doc_id").alias("doc_id"),
                    F.substring("text", 1, S.EXCERPT_CHARS).alias("excerpt"))


def context_blocks(hits: DataFrame) -> DataFrame:
    """Per question, ``\\n[Source i: filename, page p]\\n`` + text + ``\\n``
    for each hit in rank order (rank from 1), concatenated."""
    return (hits.groupBy("question_id")
            .agg(F.array_sort(F.collect_list(F.struct("rank", _piece().alias("p")))).alias("_c"))
            .select("question_id", F.array_join(F.transform("_c", lambda x: x["p"]), "").alias("context")))


def prompt_text(questions: DataFrame, contexts: DataFrame) -> DataFrame:
    """The fixed instruction with the question and its context."""
    q = questions.select("question_id", "question")
    return q.join(contexts, "question_id").select(
        "question_id", F.format_string(S.PROMPT_TEMPLATE, F.col("question"), F.col("context"))
        .alias("prompt"))


def citations(hits: DataFrame) -> DataFrame:
    """Filename, page, corpus, doc_id and the first 200 characters of
    each hit, in rank order."""
    return (hits.groupBy("question_id")
            .agg(F.array_sort(F.collect_list(F.struct("rank", _citation().alias("c")))).alias("_c"))
            .select("question_id", F.transform("_c", lambda x: x["c"]).alias("citations")))


def ask_batch(chunks: DataFrame, questions: DataFrame, embed=None, k: int = S.DEFAULT_TOP_K,
              answers: DataFrame | None = None) -> DataFrame:
    """Question (+ optional corpus) -> answer record.

    ``questions(question_id, question, corpus)``; ``embed(df) -> df`` adds an
    ``embedding`` column to the questions (the same model as the chunks), or
    questions already carry one. Questions without hits get the fixed
    "no documents" answer and no citations (V13). ``answers(question_id,
    answer)`` -- generated text from an external model -- is joined when given.
    """
    q = materialize(questions if embed is None else embed(questions), "questions")
    hits = retrieve(chunks, q.select("question_id", "embedding", "corpus"), k)
    # one group of at most k hits per question makes both the context and the citations
    per = hits.groupBy("question_id").agg(F.array_sort(F.collect_list(F.struct("rank", _piece().alias("piece"), _citation().alias("cite"))))
                                          .alias("hits"))
    out = q.select("question_id", "question", "corpus").join(per, "question_id", "left")
    has = F.col("hits").isNotNull()
    context = F.array_join(F.transform("hits", lambda x: x["piece"]), "")
    cited = F.transform("hits", lambda x: x["cite"])
    cit_type = per.select(cited.alias("c")).schema["c"].dataType
    out = out.select(
        "question_id", "question", "corpus",
        F.when(has, F.format_string(S.PROMPT_TEMPLATE, F.col("question"), context)).alias("prompt"),
        F.when(has, F.lit(None).cast("string")).otherwise(F.lit(S.NO_HITS_ANSWER)).alias("answer"),
        F.coalesce(cited, F.array().cast(cit_type)).alias("citations"))
    if answers is not None:
        a = answers.select("question_id", F.col("answer").alias("_gen"))
        out = out.join(a, "question_id", "left") \
            .withColumn("answer", F.coalesce("answer", "_gen")).drop("_gen")
    return out
