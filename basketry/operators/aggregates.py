"""User and item aggregate features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators.impute import known


def user_features(
    users: DataFrame, sessions: DataFrame, reviews: DataFrame, user: str = "user_id", rating: str = "rating"
) -> DataFrame:
    """Users with ``user_activity_frequency`` (sessions) and ``user_avg_rating``; none gives 0, NaN is none.

    Both facts are folded to one row per user before they meet the dimension.
    """
    activity = sessions.where(F.col(user).isNotNull()).groupBy(user).agg(
        F.count(F.lit(1)).alias("user_activity_frequency")
    )
    means = reviews.where(F.col(user).isNotNull()).groupBy(user).agg(F.avg(known(reviews, rating)).alias("user_avg_rating"))
    joined = users.join(activity, user, "left").join(means, user, "left")
    return joined.na.fill({"user_activity_frequency": 0, "user_avg_rating": 0.0})


def product_features(
    products: DataFrame, reviews: DataFrame, product: str = "product_id", rating: str = "rating"
) -> DataFrame:
    """Products with ``item_avg_rating`` and ``item_interaction_count`` (rows, rated or not)."""
    stats = reviews.where(F.col(product).isNotNull()).groupBy(product).agg(
        F.avg(known(reviews, rating)).alias("item_avg_rating"), F.count(F.lit(1)).alias("item_interaction_count")
    )
    joined = products.join(stats, product, "left")
    return joined.na.fill({"item_avg_rating": 0.0, "item_interaction_count": 0})
