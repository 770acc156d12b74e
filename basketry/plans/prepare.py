"""The five dataset preparations, each a chain of operators in contract order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.coercion import extract_number, nan_to_null, numeric_column
from basketry.functions.temporal import (
    KNOWN_FORMATS, hour_or_minus_one, infer_format, month_or_zero, parse_datetime, year_or_zero,
)
from basketry.operators.dedup import keep_first
from basketry.operators.encode import clip_at_zero, label_encode, log_scale, minmax_scale
from basketry.operators.impute import drop_missing, fill_constants, median_impute
from basketry.session import materialize

# Date columns without a given format take that of their first value.
Order = Sequence[str | Column]


def first_rows(df: DataFrame, key: str, order: Order) -> DataFrame:
    """The deduplicated table, written once: the statistics that follow read single columns of it."""
    return materialize(keep_first(nan_to_null(df), [key], order), "first-rows")


def prepare_users(
    df: DataFrame, order: Order, date_format: str | None = None, formats: Sequence[str] = KNOWN_FORMATS
) -> DataFrame:
    """Dedup, median age, gender fill, three codes, signup year and month, scaled age."""
    out = first_rows(df, "user_id", order)
    out = out.withColumn("age", numeric_column(out, "age"))
    out = median_impute(out, ["age"])
    out = fill_constants(out, {"gender": "Unknown"})
    out = label_encode(
        out, {"gender": "gender_encoded", "membership": "membership_encoded", "customer_segment": "segment_encoded"}
    )
    fmt = date_format or infer_format(out, "signup_date", order, formats)
    out = out.withColumn("signup_date", parse_datetime(out, "signup_date", fmt, formats))
    out = out.withColumns(
        {"signup_year": year_or_zero(F.col("signup_date")), "signup_month": month_or_zero(F.col("signup_date"))}
    )
    return minmax_scale(out, {"age": "age_normalized"})


def prepare_products(df: DataFrame, order: Order) -> DataFrame:
    """Dedup, median price, rating from text, two codes, log price."""
    out = first_rows(df, "product_id", order)
    out = out.withColumn("price", numeric_column(out, "price"))
    out = median_impute(out, ["price"])
    out = out.withColumn("avg_rating", F.coalesce(extract_number(F.col("avg_rating")), F.lit(0.0)))
    out = label_encode(out, {"category": "category_encoded", "brand": "brand_encoded"})
    return log_scale(out, {"price": "price_log_normalized"})


def prepare_reviews(
    df: DataFrame, order: Order, date_format: str | None = None, formats: Sequence[str] = KNOWN_FORMATS
) -> DataFrame:
    """Dedup, drop rows without user or product, middle rating for none, sentiment code, date."""
    out = first_rows(df, "review_id", order)
    out = drop_missing(out, ["user_id", "product_id"])
    out = out.withColumn("rating", numeric_column(out, "rating"))
    out = fill_constants(out, {"rating": 3.0})
    out = label_encode(out, {"sentiment": "sentiment_encoded"})
    fmt = date_format or infer_format(out, "review_date", order, formats)
    return out.withColumn("review_date", parse_datetime(out, "review_date", fmt, formats))


def prepare_sessions(df: DataFrame, order: Order) -> DataFrame:
    """Dedup, zero for no duration, scaled duration."""
    out = first_rows(df, "session_id", order)
    out = out.withColumn("session_duration_sec", numeric_column(out, "session_duration_sec"))
    out = fill_constants(out, {"session_duration_sec": 0.0})
    return minmax_scale(out, {"session_duration_sec": "duration_normalized"})


def clean_events(df: DataFrame, timestamp_format: str | None = None, formats: Sequence[str] = KNOWN_FORMATS) -> DataFrame:
    """The row-wise part of the clickstream preparation, for batches and streams alike."""
    out = drop_missing(df, ["session_id", "user_id", "product_id"])
    out = out.withColumn("event_timestamp", parse_datetime(out, "event_timestamp", timestamp_format, formats))
    dwell = clip_at_zero(F.coalesce(numeric_column(out, "dwell_time_sec"), F.lit(0.0)))
    return out.withColumns({"event_hour": hour_or_minus_one(F.col("event_timestamp")), "dwell_time_sec": dwell})


def prepare_clickstream(
    df: DataFrame, order: Order, timestamp_format: str | None = None, formats: Sequence[str] = KNOWN_FORMATS
) -> DataFrame:
    """Dedup first, then drop unlinked rows, hour, dwell time, event code."""
    first = first_rows(df, "event_id", order)
    linked = drop_missing(first, ["session_id", "user_id", "product_id"])
    out = clean_events(first, timestamp_format or infer_format(linked, "event_timestamp", order, formats), formats)
    return label_encode(out, {"event_type": "event_type_encoded"})
