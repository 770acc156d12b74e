"""The registered queries of the text operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import bpe, chat, decontaminate, jaccard, kneser_ney, langid, merkle, packing, phrases, pii, repair, rules, sharding


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """The vocabulary file that the packing and encoding queries are defined on."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(_table(spark, sf_dir, "documents"))


def op2_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked_components(_table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.digest(_table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.digest(_table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, _table(spark, sf_dir, "documents"), tokenizer_path())


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(chat.with_probe(spark, _table(spark, sf_dir, "conversations")))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.digest(_table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(spark, _table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(_table(spark, sf_dir, "documents"))


def op12_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(_table(spark, sf_dir, "documents"), tokenizer_path())


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.digest(_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pii_pseudonyms,
        op2_kneser_ney_quality,
        op3_jaccard_join,
        op4_substring_dedup,
        op5_benchmark_decontamination,
        op6_quality_rules,
        op7_best_fit_packing,
        op8_chat_formatting,
        op9_language_id,
        op10_sharding,
        op11_merkle_manifest,
        op12_bpe_tree,
        op13_conversation_repair,
    )
}
