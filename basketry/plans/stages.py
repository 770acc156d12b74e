"""The whole flow over a lake root: ingest, validate, prepare, load, materialise, train, audit.

Each stage reads the zone tables of the one before and writes its own, so a
stage can be run again alone.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators import evaluate, feature_store, holdout, profile, quality, recommend
from basketry.plans import prepare, warehouse
from basketry.sources import landing, zones
from basketry.sources.files import SEQ, read_payloads
from basketry.specs import DATASETS, FEATURE_VIEWS

TRAIN_INPUTS = ("dim_users", "dim_products", "fact_interactions")
PREPARERS = {
    "users": prepare.prepare_users,
    "products": prepare.prepare_products,
    "reviews": prepare.prepare_reviews,
    "sessions": prepare.prepare_sessions,
    "clickstream": prepare.prepare_clickstream,
}


def ingest(spark: SparkSession, sources: Mapping[str, str], lake: str, date: str, payloads: str | None = None) -> DataFrame:
    """Land every CSV (and fetched JSON responses) under ``date``; one metrics row each."""
    metrics = landing.ingest(spark, sources.items(), f"{lake}/raw", date, DATASETS)
    if payloads is None:
        return metrics
    try:
        row = ("payloads", True, landing.ingest_payloads(read_payloads(spark, payloads), f"{lake}/external/payloads", date), None)
    except Exception as error:  # as with any other source, the rest goes on
        row = ("payloads", False, 0, str(error).split("\n")[0])
    return metrics.unionByName(spark.createDataFrame([row], metrics.schema))


def validate(spark: SparkSession, lake: str) -> tuple[DataFrame, DataFrame]:
    """(quality report, gate): profile each dataset's latest landing, promote what passes.

    A dataset without a contract lacks no column and breaks no rule; its duplicates still decide.
    """
    tables = {name: landing.read_latest(spark, f"{lake}/raw/{name}") for name in landing.landed(spark, f"{lake}/raw")}
    if not tables:
        raise FileNotFoundError(f"no landed dataset under {lake}/raw")
    report, schema = quality.profile_datasets(spark, {name: df.drop(SEQ) for name, df in tables.items()}, DATASETS)
    zones.write_table(report, f"{lake}/reports", "quality")
    report = zones.require_tables(spark, f"{lake}/reports", ["quality"])["quality"]
    gate = quality.gate(schema, report)
    zones.promote(tables, gate, f"{lake}/validated")
    return report, gate


def prepare_all(spark: SparkSession, lake: str) -> list[str]:
    """Prepare every validated dataset; one that is absent is skipped. The processed tables change as one set."""
    ready = {}
    for name, df in zones.require_tables(spark, f"{lake}/validated", zones.existing(spark, f"{lake}/validated", PREPARERS)).items():
        order = [SEQ] if SEQ in df.columns else [c for c in df.columns if c != DATASETS[name].key]
        ready[name] = PREPARERS[name](df, order).drop(SEQ)
    zones.write_tables(ready, f"{lake}/processed")
    return list(ready)


def explore(spark: SparkSession, lake: str) -> dict[str, DataFrame]:
    """The chart datasets: rating histogram, most reviewed items, matrix sparsity."""
    reviews = zones.require_tables(spark, f"{lake}/validated", ["reviews"])["reviews"]
    rated = reviews.withColumn("rating", F.col("rating").try_cast("double"))
    return {
        "rating_histogram": profile.histogram(rated, "rating"),
        "item_popularity": profile.top_items(reviews, "product_id"),
        "sparsity": profile.matrix_sparsity(reviews, "user_id", "product_id"),
    }


def load_warehouse(spark: SparkSession, lake: str) -> DataFrame:
    """Build the star schema, check every constraint, write it, return the table counts."""
    inputs = zones.require_tables(spark, f"{lake}/processed", ["users", "products", "reviews", "sessions"])
    warehouse.load(spark, warehouse.build(**inputs), f"{lake}/warehouse")
    return zones.table_counts(zones.require_tables(spark, f"{lake}/warehouse", TRAIN_INPUTS))


def materialize_features(spark: SparkSession, lake: str, version: str | None = None, at: str | None = None) -> DataFrame:
    """Write both feature views under ``version`` (default: the time) and return the registry."""
    version, at = version or feature_store.new_version(), at or feature_store.now()
    tables = zones.require_tables(spark, f"{lake}/warehouse", ["dim_users", "dim_products"])
    path = f"{lake}/features"
    feature_store.write_features(feature_store.unpivot_views(tables, FEATURE_VIEWS, version, at), path)
    current = feature_store.read_current(spark, path).select("feature_view", F.inline("features"))
    return feature_store.registry(current, FEATURE_VIEWS, spark)


def train(spark: SparkSession, lake: str, run_id: str, k: int = 5) -> DataFrame:
    """Hold out, recommend with both models, store the lists, log and return the metrics."""
    t = zones.require_tables(spark, f"{lake}/warehouse", TRAIN_INPUTS)
    dated = t["fact_interactions"].withColumn("review_date", F.col("review_date").try_cast("timestamp"))
    kept, held = holdout.train_test(dated, "user_id", "review_date", "review_id")
    if held.isEmpty():
        raise ValueError("no user has two interactions, so nothing can be held out")
    content = recommend.recommend_content(t["dim_users"], t["dim_products"], kept, k)
    zones.write_table(content, f"{lake}/recommendations", "content")
    lists = {
        "popularity": recommend.recommend_popular(t["dim_users"], t["dim_products"], k),
        "content_tfidf": zones.require_tables(spark, f"{lake}/recommendations", ["content"])["content"],
    }
    report = evaluate.compare_models(held, lists, k)
    zones.write_table(report, f"{lake}/reports", "evaluation")
    report = zones.require_tables(spark, f"{lake}/reports", ["evaluation"])["evaluation"]
    evaluate.metric_rows(report, run_id).write.mode("append").parquet(f"{lake}/reports/metrics")
    evaluate.run_summary(kept, held, run_id, k).write.mode("append").parquet(f"{lake}/reports/runs")
    # One row per model: the same report for readers without Spark.
    report.coalesce(1).write.mode("overwrite").json(f"{lake}/reports/evaluation_json")
    report.coalesce(1).write.mode("overwrite").csv(f"{lake}/reports/evaluation_csv", header=True)
    return report


def recommend_for(spark: SparkSession, lake: str, requests: DataFrame, k: int = 5) -> DataFrame:
    """The stored content lists of the requested users; needs an earlier ``train``."""
    stored = zones.require_tables(spark, f"{lake}/recommendations", ["content"])["content"]
    return recommend.lookup(requests, stored, k)


def audit_stages(spark: SparkSession, lake: str) -> DataFrame:
    """Measured lineage: counts, keys and content hash of each dataset in each zone that has it."""
    found = []
    for name, spec in DATASETS.items():
        for zone in ("validated", "processed"):
            df = zones.read_table(spark, f"{lake}/{zone}", name)
            if df is not None:
                found.append((name, zone, df.drop(SEQ), spec.key))
    for name, key in warehouse.PRIMARY_KEYS.items():
        df = zones.read_table(spark, f"{lake}/warehouse", name)
        if df is not None:
            found.append((name, "warehouse", df, key))
    return profile.stage_audit(found)


def run_all(
    spark: SparkSession, sources: Mapping[str, str], lake: str, date: str, version: str, at: str, k: int = 5, payloads: str | None = None
) -> DataFrame:
    """All stages in order; returns the model report. Chart datasets and the stage audit are stored under ``reports``."""
    ingest(spark, sources, lake, date, payloads)
    validate(spark, lake)
    zones.write_tables({f"chart_{name}": chart for name, chart in explore(spark, lake).items()}, f"{lake}/reports")
    prepare_all(spark, lake)
    load_warehouse(spark, lake)
    materialize_features(spark, lake, version, at)
    report = train(spark, lake, run_id=version, k=k)
    zones.write_table(audit_stages(spark, lake), f"{lake}/reports", "stage_audit")
    return report
