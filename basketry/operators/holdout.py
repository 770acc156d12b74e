"""Per-user last-interaction holdout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.session import materialize


def held_keys(df: DataFrame, user: str, time: str, key: str) -> DataFrame:
    """(_held): the key of the last row of every user with at least two, by (time, key), nulls earliest.

    An aggregate of time and key, not a window: a user with a third of all rows is folded on the
    map side. Rows without a user are never held out.
    """
    last = F.max_by(key, F.struct(time, key))
    per_user = df.where(F.col(user).isNotNull()).groupBy(user).agg(F.count(F.lit(1)).alias("_n"), last.alias("_held"))
    return per_user.where("_n >= 2").select("_held")


def last_interactions(df: DataFrame, user: str, time: str, key: str) -> DataFrame:
    """The rows of ``held_keys``; ``key`` must be unique. It has no hot values, and one key a user is broadcast where that is small."""
    held = held_keys(df, user, time, key)
    return df.join(held, df[key].eqNullSafe(held["_held"]), "left_semi")


def holdout_split(df: DataFrame, user: str, time: str, key: str) -> DataFrame:
    """``df`` with ``is_test``: true on each eligible user's last row. ``key`` must be unique."""
    held = held_keys(df, user, time, key).withColumn("_test", F.lit(True))
    flagged = df.join(held, df[key].eqNullSafe(held["_held"]), "left")
    return flagged.withColumn("is_test", F.coalesce("_test", F.lit(False))).drop("_held", "_test")


def train_test(df: DataFrame, user: str, time: str, key: str) -> tuple[DataFrame, DataFrame]:
    """(all rows but the held out, the held out). The held-out keys, one per user, are stored once."""
    held = materialize(held_keys(df, user, time, key), "held-out")
    match = df[key].eqNullSafe(held["_held"])
    return df.join(held, match, "left_anti"), df.join(held, match, "left_semi")
