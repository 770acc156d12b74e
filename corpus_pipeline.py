"""Training-data pipeline: rules, near-duplicate join, decontamination, pseudonyms, packing.

Each stage works on all rows that its predecessor kept; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import decontaminate, jaccard, packing, pii, rules
from basketry.llm.queries import tokenizer_path
from basketry.session import materialize, small_batches

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Rows are whole texts: a task holds so many at most in an Arrow batch, on both sides.
BATCH_ROWS = 1000


def whole_texts(stage: Stage) -> Stage:
    """A stage whose frame is read after it returns, with the batches of ``BATCH_ROWS`` that the session then keeps."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        name = "spark.sql.execution.arrow.maxRecordsPerBatch"
        now = int(spark.conf.get(name))
        spark.conf.set(name, str(min(BATCH_ROWS, now) if now > 0 else BATCH_ROWS))
        return stage(spark, docs, sf_dir)

    return run_stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the base rules or the thresholds of their group reject."""
    return rules.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingle sets."""
    return jaccard.drop_near_duplicates(docs)


@whole_texts
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents of which a twentieth of the words or more is benchmark text."""
    return decontaminate.remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@whole_texts
def pii_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data and secrets as pseudonyms."""
    return pii.mask(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack(spark, docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii_pseudonyms", pii_pseudonyms),
    ("best_fit_packing", best_fit_packing),
]

#: SQL has no tokenizer, so the tests hold ``run`` against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with small_batches(spark, BATCH_ROWS):
        for name, stage in STAGES:
            docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
