"""Recommendation-shaped views over the test tables, as SQL that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# {k} is the engine's way to read the number k out of events.props.
VIEWS = {
    "v_users": """
        SELECT c_custkey AS user_id,
               CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS age,
               CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_mktsegment END AS gender,
               CAST(c_nationkey AS VARCHAR(3)) AS city,
               c_mktsegment AS membership, CAST(c_nationkey AS VARCHAR(3)) AS customer_segment,
               CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN c_name
                    ELSE concat(c_name, '@example.com') END AS email,
               CASE WHEN c_custkey % 11 = 0 THEN 'not a date'
                    ELSE concat(CAST(2015 + c_custkey % 9 AS VARCHAR(4)), '-0',
                                CAST(1 + c_custkey % 9 AS VARCHAR(1)), '-15') END AS signup_date
        FROM {customer}""",
    "v_products": """
        SELECT p_partkey AS product_id, p_name AS product_name,
               CASE WHEN p_partkey % 53 = 0 THEN NULL ELSE p_type END AS category, p_brand AS brand,
               CASE WHEN p_partkey % 31 = 0 THEN NULL ELSE p_retailprice END AS price,
               CASE WHEN p_partkey % 4 = 0 THEN concat(CAST(p_size % 5 AS VARCHAR(1)), '.5 out of 5 stars')
                    WHEN p_partkey % 4 = 1 THEN CAST(p_size % 7 AS VARCHAR(1))
                    WHEN p_partkey % 4 = 2 THEN 'n/a' END AS avg_rating,
               concat(p_brand, ' ', p_type) AS description
        FROM {part}""",
    "v_reviews": """
        SELECT l_orderkey * 10 + l_linenumber AS review_id, o_custkey AS user_id, l_partkey AS product_id,
               CASE WHEN l_suppkey % 19 = 0 THEN NULL
                    ELSE CAST(1 + floor((l_quantity - 1) / 10) AS DOUBLE) END AS rating,
               l_returnflag AS sentiment, o_orderdate AS review_date,
               l_shipdate, l_suppkey, l_extendedprice
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    # The same rows with a rating of 0..6.
    "v_dirty": """
        SELECT l_orderkey * 10 + l_linenumber AS review_id, o_custkey AS user_id, l_partkey AS product_id,
               CAST(floor(l_quantity / 8) AS DOUBLE) AS rating
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "v_sessions": """
        SELECT o_orderkey AS session_id, o_custkey AS user_id, o_orderdate AS session_start,
               CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_totalprice END AS session_duration_sec
        FROM {orders}""",
    "v_clickstream": """
        SELECT event_id,
               CASE WHEN event_id % 37 = 0 THEN NULL ELSE user_id * 100 + day(ts) END AS session_id,
               user_id, CAST({k} AS BIGINT) AS product_id, ts AS event_timestamp, event_type,
               CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 31 = 0 THEN -value
                    ELSE value END AS dwell_time_sec
        FROM {events}""",
    # Documents as catalogue items, events on them as interactions.
    "v_items": """
        SELECT doc_id AS product_id, source AS product_name, lang AS category, text AS description
        FROM {documents}""",
    "v_interactions": """
        SELECT event_id AS review_id, user_id, CAST({k} AS BIGINT) AS product_id,
               value AS rating, ts AS review_date
        FROM {events}""",
}
SPARK_K = "get_json_object(props, '$.k')"
DUCKDB_K = "json_extract_string(props, '$.k')"

DATASET_VIEWS = {
    "users": "v_users",
    "products": "v_products",
    "reviews": "v_reviews",
    "sessions": "v_sessions",
    "clickstream": "v_clickstream",
}
# Keep-first order: every column, so that rows still tied are identical.
REVIEW_ORDER = (
    "l_shipdate", "l_suppkey", "l_extendedprice", "user_id", "product_id", "rating", "sentiment", "review_date",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame over the Parquet tables."""
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in VIEWS[name]}
    return spark.sql(VIEWS[name].replace("{k}", SPARK_K), **used)


def view_sql(*names: str) -> str:
    """The views as a WITH list for DuckDB, over tables registered by name."""
    parts = []
    for name in names:
        sql = VIEWS[name].replace("{k}", DUCKDB_K)
        for t in TABLES:
            sql = sql.replace("{" + t + "}", t)
        parts.append(f"{name} AS ({sql})")
    return ",\n".join(parts)
