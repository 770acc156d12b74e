"""Precision, recall and NDCG of ranked lists against held-out items."""

from __future__ import annotations

from math import log2

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.literals import doubles

USER, PRODUCT = "user_id", "product_id"
DEALT = 200  # up to so many partitions rows are dealt straight to files, without a buffer in the task


def user_metrics(test: DataFrame, recommendations: DataFrame, k: int = 5) -> DataFrame:
    """(user, precision, recall, ndcg) of each test user who has a list.

    Precision divides by the list's length; the ideal gain counts min(true, k) places.
    Listed and held-out pairs are stacked and folded, per pair and then per user:
    no join, and no user's pairs in one task before they are folded. Listed pairs hardly repeat, and a
    scan of a few bytes a user can make all of them in one task: they are dealt by pair first, so that
    no task folds more than its share.
    """
    folded = test.where(F.col(USER).isNotNull()).select(USER, PRODUCT).distinct()
    held = folded.select(USER, PRODUCT, F.lit(None).cast("int").alias("rank"), F.lit(1).alias("true"))
    listed = recommendations.where(F.col("rank") <= k).select(USER, PRODUCT, "rank", F.lit(0).alias("true"))
    # A given number of partitions: by bytes these narrow rows look small and would be merged.
    parts = min(DEALT, int(test.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = held.unionByName(listed).repartition(parts, USER, PRODUCT)
    pairs = dealt.groupBy(USER, PRODUCT).agg(F.min("rank").alias("rank"), F.max("true").alias("true"))
    gain = F.when(F.col("true") == 1, 1 / F.log2(F.col("rank") + 1))  # null when not listed
    per_user = pairs.groupBy(USER).agg(
        F.count("rank").alias("n_listed"),
        F.sum("true").alias("n_true"),
        F.count(gain).alias("n_hits"),
        F.coalesce(F.sum(gain), F.lit(0.0)).alias("dcg"),
    )
    ideal = doubles([sum(1 / log2(r + 2) for r in range(n)) for n in range(1, k + 1)])
    best = F.element_at(ideal, F.least("n_true", F.lit(k)).cast("int"))
    return per_user.where("n_listed > 0 AND n_true > 0").select(
        USER,
        (F.col("n_hits") / F.col("n_listed")).alias("precision"),
        (F.col("n_hits") / F.col("n_true")).alias("recall"),
        (F.col("dcg") / best).alias("ndcg"),
    )


def evaluate_at_k(test: DataFrame, recommendations: DataFrame, k: int = 5) -> DataFrame:
    """One row (n_users, precision, recall, ndcg): means over users, 0.0 without any."""
    per_user = user_metrics(test, recommendations, k)
    return per_user.agg(
        F.count(F.lit(1)).alias("n_users"),
        *(F.coalesce(F.avg(m), F.lit(0.0)).alias(m) for m in ("precision", "recall", "ndcg")),
    )


def compare_models(test: DataFrame, lists: dict[str, DataFrame], k: int = 5) -> DataFrame:
    """One row per model: (model, k, n_users, precision, recall, ndcg)."""
    out = None
    for model, recs in lists.items():
        row = evaluate_at_k(test, recs, k).select(F.lit(model).alias("model"), F.lit(k).alias("k"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def run_summary(train: DataFrame, test: DataFrame, run_id: str, k: int) -> DataFrame:
    """One row about a training run: (run_id, strategy, top_k, n_train, n_test, n_test_users)."""
    held = test.agg(F.count(F.lit(1)).alias("n_test"), F.count_distinct(USER).alias("n_test_users"))
    kept = train.agg(F.count(F.lit(1)).alias("n_train")).scalar()
    return held.select(
        F.lit(run_id).alias("run_id"), F.lit("per-user holdout").alias("strategy"), F.lit(k).alias("top_k"),
        kept.alias("n_train"), "n_test", "n_test_users",
    )


def metric_rows(report: DataFrame, run_id: str) -> DataFrame:
    """A model report as log rows (run_id, model, k, metric, value), to append."""
    long = report.unpivot(["model", "k"], ["precision", "recall", "ndcg"], "metric", "value")
    return long.select(F.lit(run_id).alias("run_id"), "*")
