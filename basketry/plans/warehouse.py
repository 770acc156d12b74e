"""Star schema: two dimensions, one fact, with their declared types and constraints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators import integrity
from basketry.operators.integrity import require_clean
from basketry.sources import commits
from basketry.operators.aggregates import product_features, user_features

# The warehouse contract.
DIM_USERS = {
    "user_id": "string", "age": "double", "gender": "string", "city": "string", "membership": "string",
    "signup_year": "long", "user_activity_frequency": "long", "user_avg_rating": "double",
}
DIM_PRODUCTS = {
    "product_id": "string", "product_name": "string", "category": "string", "brand": "string", "price": "double",
    "item_avg_rating": "double", "item_interaction_count": "long", "description": "string",
}
FACT_INTERACTIONS = {
    "review_id": "string", "user_id": "string", "product_id": "string", "rating": "double",
    "sentiment_encoded": "long", "review_date": "string",
}
PRIMARY_KEYS = {"dim_users": "user_id", "dim_products": "product_id", "fact_interactions": "review_id"}
NOT_NULL = {
    "dim_users": ("user_activity_frequency", "user_avg_rating"),
    "dim_products": ("product_name", "item_avg_rating", "item_interaction_count"),
    "fact_interactions": ("user_id", "product_id", "rating"),
}
FOREIGN_KEYS = (("user_id", "dim_users"), ("product_id", "dim_products"))
RATING_BOUNDS = (1, 5)


def build(users: DataFrame, products: DataFrame, reviews: DataFrame, sessions: DataFrame) -> dict[str, DataFrame]:
    """The three tables from prepared inputs. Cast to the declared types; a missing
    optional column is null."""
    dated = reviews.withColumn("review_date", F.col("review_date").cast("string"))
    return {
        "dim_users": _conform(user_features(users, sessions, reviews), DIM_USERS),
        "dim_products": _conform(product_features(products, reviews), DIM_PRODUCTS),
        "fact_interactions": _conform(dated, FACT_INTERACTIONS),
    }


def audits(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every declared constraint as an audit of its violations."""
    found: dict[str, DataFrame] = {}
    for name, key in PRIMARY_KEYS.items():
        found[f"{name}: primary key {key}"] = integrity.primary_key(tables[name], [key])
        found[f"{name}: not null"] = integrity.not_null(tables[name], NOT_NULL[name])
    fact = tables["fact_interactions"]
    for column, dim in FOREIGN_KEYS:
        found[f"fact_interactions: foreign key {column}"] = integrity.foreign_key(fact, column, tables[dim], column)
    found["fact_interactions: rating bounds"] = integrity.check_between(fact, "rating", *RATING_BOUNDS)
    return found


def load(spark: SparkSession, tables: dict[str, DataFrame], root: str) -> int:
    """Write the star schema under ``root`` and return the number of its record.

    The tables are written once, as versions that no reader sees, and audited there; only when all
    constraints hold does a record make them the warehouse, all three at once.
    """
    staged = commits.stage(tables, root)
    require_clean(audits({name: spark.read.parquet(f"{root}/{path}") for name, path in staged.items()}))
    return commits.commit(spark, root, staged)


def _conform(df: DataFrame, types: dict[str, str]) -> DataFrame:
    absent = {c: F.lit(None) for c in types if c not in df.columns}
    return integrity.conform(df.withColumns(absent) if absent else df, types)
