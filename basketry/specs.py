"""Dataset contracts: columns, keys, required fields, value rules, feature views.

Names and bounds in this file are fixed values of the data contract.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RangeRule:
    """``low <= column <= high``; an open end is None. Nulls never break a range."""

    column: str
    low: float | None
    high: float | None = None
    embedded: bool = False  # accept text such as '4.6 out of 5 stars'


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    columns: tuple[str, ...]
    key: str
    required: tuple[str, ...]
    ranges: tuple[RangeRule, ...] = ()
    email_column: str | None = None
    free_text: bool = False  # quoted fields may hold line breaks


DATASETS: dict[str, DatasetSpec] = {
    spec.name: spec
    for spec in (
        DatasetSpec(
            "users",
            ("user_id", "age", "gender", "city", "membership", "preferred_category",
             "signup_date", "customer_segment", "is_active"),
            key="user_id",
            required=("user_id",),
            ranges=(RangeRule("age", 0, 120),),
            email_column="email",
        ),
        DatasetSpec(
            "products",
            ("product_id", "product_name", "category", "brand", "price", "avg_rating",
             "rating_count", "availability", "bestseller_rank", "description"),
            key="product_id",
            required=("product_id", "product_name"),
            ranges=(RangeRule("price", 0), RangeRule("avg_rating", 0, 5, embedded=True)),
            free_text=True,
        ),
        DatasetSpec(
            "reviews",
            ("review_id", "user_id", "product_id", "rating", "review_text", "sentiment",
             "verified_purchase", "review_date"),
            key="review_id",
            required=("review_id", "user_id", "product_id"),
            ranges=(RangeRule("rating", 1, 5),),
            free_text=True,
        ),
        DatasetSpec(
            "sessions",
            ("session_id", "user_id", "session_start", "session_end", "device", "browser",
             "traffic_source", "session_duration_sec", "pages_visited", "bounce", "conversion"),
            key="session_id",
            required=("session_id", "user_id"),
            ranges=(RangeRule("session_duration_sec", 0),),
        ),
        DatasetSpec(
            "clickstream",
            ("event_id", "session_id", "user_id", "product_id", "event_timestamp", "event_type",
             "page", "device", "browser", "traffic_source", "dwell_time_sec", "recommendation_flag"),
            key="event_id",
            required=("event_id", "session_id", "user_id", "product_id"),
        ),
    )
}


@dataclass(frozen=True)
class FeatureView:
    name: str
    source_table: str
    join_key: str
    description: str
    features: tuple[tuple[str, str], ...]  # (feature, type)


USER_VIEW = FeatureView(
    "user_features",
    "dim_users",
    "user_id",
    "Per-user profile with activity and mean rating.",
    (
        ("age", "REAL"),
        ("gender", "TEXT"),
        ("city", "TEXT"),
        ("membership", "TEXT"),
        ("user_activity_frequency", "INTEGER"),
        ("user_avg_rating", "REAL"),
    ),
)
PRODUCT_VIEW = FeatureView(
    "product_features",
    "dim_products",
    "product_id",
    "Per-product profile with price, mean rating and interaction count.",
    (
        ("product_name", "TEXT"),
        ("category", "TEXT"),
        ("brand", "TEXT"),
        ("price", "REAL"),
        ("item_avg_rating", "REAL"),
        ("item_interaction_count", "INTEGER"),
    ),
)
FEATURE_VIEWS = (USER_VIEW, PRODUCT_VIEW)
