"""Chart datasets and stage audits."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.operators.fingerprint import value_hash
from basketry.operators.impute import present


def histogram(df: DataFrame, column: str, bins: int = 5) -> DataFrame:
    """Equal-width histogram over min..max: (bin, low, high, n), the last bin closed, empty bins kept.

    A single-valued column is binned over value - 0.5 .. value + 0.5; nulls and NaN are left out.
    """
    known = df.select(present(column).cast("double").alias("x")).where(F.col("x").isNotNull())
    lo, hi = F.min("x"), F.max("x")
    edges = known.agg(
        F.when(lo == hi, lo - 0.5).otherwise(lo).alias("lo"), F.when(lo == hi, hi + 0.5).otherwise(hi).alias("hi")
    ).select("lo", "hi", ((F.col("hi") - F.col("lo")) / bins).alias("step"))
    e = edges.select(F.struct("lo", "hi", "step").alias("e")).scalar()
    place = F.lit(0)
    for i in range(1, bins):
        place = place + F.when(F.col("x") >= e["lo"] + e["step"] * i, 1).otherwise(0)
    counts = known.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = edges.where("lo IS NOT NULL").select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "hi", "step"
    )
    return frame.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("step") * F.col("bin")).alias("low"),
        F.when(F.col("bin") == bins - 1, F.col("hi")).otherwise(F.col("lo") + F.col("step") * (F.col("bin") + 1)).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def top_items(df: DataFrame, item: str, k: int = 15) -> DataFrame:
    """The k items with most rows, ties by id."""
    counts = df.where(F.col(item).isNotNull()).groupBy(item).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), item).limit(k)


def distinct_count(df: DataFrame, column: str) -> Column:
    """The number of distinct values, as a scalar subquery: ids are folded on the map side and counted alone."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().agg(F.count(F.lit(1))).scalar()


def matrix_sparsity(df: DataFrame, user: str, item: str) -> DataFrame:
    """One row: rows, distinct users, distinct items, 1 - rows / (users * items); no cells gives null.

    Three aggregates of one column each; one over both columns would copy every row.
    """
    counted = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", distinct_count(df, user).alias("n_users"), distinct_count(df, item).alias("n_items")
    )
    cells = F.nullif(F.col("n_users").cast("double") * F.col("n_items"), F.lit(0.0))
    return counted.withColumn("sparsity", 1 - F.col("n_rows") / cells)


def exploration_summary(reviews: DataFrame, clickstream: DataFrame, user: str = "user_id", item: str = "product_id") -> DataFrame:
    """One row: n_reviews, n_events, distinct users and items of the reviews, and the sparsity of their matrix."""
    events = clickstream.agg(F.count(F.lit(1))).scalar()
    counted = matrix_sparsity(reviews, user, item)
    return counted.select(F.col("n_rows").alias("n_reviews"), events.alias("n_events"), "n_users", "n_items", "sparsity")


def stage_audit(stages: Iterable[tuple[str, str, DataFrame, str]]) -> DataFrame:
    """Measured lineage: (track, stage, n_rows, n_keys, content_hash) per (track, stage, table, key)."""
    out = None
    for track, stage, df, key in stages:
        part = df.agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_keys"), F.sum(value_hash(*df.columns)).alias("content_hash")
        ).select(F.lit(track).alias("track"), F.lit(stage).alias("stage"), "n_rows", "n_keys", "content_hash")
        out = part if out is None else out.unionByName(part)
    return out
