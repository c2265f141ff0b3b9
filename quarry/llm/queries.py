"""The registered corpus queries: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import (
    decontaminate,
    fingerprints,
    langid,
    line_dedup,
    merkle,
    minhash,
    mixing,
    packing,
    polytope,
    suffixes,
    toxicity,
    variants,
    wrappers,
)
from quarry.llm.common import table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents")).drop("source")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_report(table(spark, sf_dir, "documents"))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.suffix_report(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polytope.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_report(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_report(table(spark, sf_dir, "documents"))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_mixing, op2_line_dedup, op3_minhash, op4_language, op5_html, op6_packing, op7_suffixes, op8_toxicity,
        op9_embeddings, op10_fingerprints, op11_merkle, op12_decontaminate, op13_variants)}


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": line_dedup.REPORT_SQL, "op11_merkle": merkle.REPORT_SQL,
            "op12_decontaminate": decontaminate.REPORT_SQL, "op13_variants": variants.REPORT_SQL}
