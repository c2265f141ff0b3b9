"""A corpus pipeline of five operators: toxicity, line dedup, MinHash
near-dedup, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``. ``run`` writes every stage to the shared scratch
folder and reads it back, so that a stage starts from stored rows.

Every stage takes nulls in any column, empty and very long texts, ties, repeated rows, an empty
table and further columns of any name, which stay as they are. What each does with them is said
in its docstring.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import line_dedup, minhash, mixing, packing, toxicity
from quarry.llm.common import cut, table
from quarry.llm.queries import tokenizer_path


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects go. A text that is null or without words has the
    chain's prior; without labels nothing goes; repeated rows are judged each for itself, alike."""
    labels = toxicity.category_labels(table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, toxicity.train(docs, labels))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, n_chars follows the text. A null or empty text stays as it is; rows without a doc_id
    lose nothing; rows that repeat a doc_id count as one document and lose the same lines; the greatest doc_id keeps a line."""
    return line_dedup.cut_lines(docs)


def minhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the least doc_id. Documents without words and
    rows without a doc_id stay; rows that repeat a doc_id are one document and stay or go together."""
    return minhash.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents appear as often as the mix of sources takes them. A null source is one of its own, ranked last;
    documents without words stay once; equal rows are told apart by their place in the stored table."""
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences. A null or empty text is the end id alone; repeated rows are packed
    each for itself; further columns are left out."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_dedup_stage),
    ("minhash near-dedup", minhash_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# Learned, iterated and packed stages have no SQL; tests/llm checks each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
