"""Popularity and content-based top-k recommendations as rows (user, rank, product, score)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.text import joined_text
from basketry.operators import tfidf
from basketry.operators.impute import known
from basketry.operators.scoring import (
    BROADCAST_BYTES, ENTRY_BYTES, ID_BYTES, Queries, best_items, listed, shared_vectors, stored_vectors, sum_runs, summed,
)
from basketry.session import materialize, spread

USER, PRODUCT = "user_id", "product_id"
TEXT_COLUMNS = ("product_name", "category", "description")


def popular_products(products: DataFrame, k: int = 5) -> DataFrame:
    """The k products with most interactions, then best mean rating, then lowest id; a mean that is null or NaN comes last."""
    rated = products.withColumn("item_avg_rating", known(products, "item_avg_rating"))
    return rated.orderBy(F.desc("item_interaction_count"), F.desc("item_avg_rating"), PRODUCT).limit(k)


def popular_array(products: DataFrame, k: int) -> Column:
    """The same k ids as one array, ranked: a scalar subquery of k elements."""
    count, rating = F.col("item_interaction_count"), F.col("item_avg_rating")
    order = F.struct(  # a null comes last, as in popular_products
        count.isNull().alias("a0"), (-count).alias("a"), rating.isNull().alias("b0"), (-rating).alias("b"), F.col(PRODUCT).alias("id")
    )
    ranked = popular_products(products, k).agg(F.array_sort(F.collect_list(order)).alias("r"))
    return ranked.select(F.transform("r", lambda s: s["id"]).alias("ids")).scalar()


def recommend_popular(users: DataFrame, products: DataFrame, k: int = 5) -> DataFrame:
    """The same k products for every user; the user table is not shuffled."""
    listed = users.select(USER, F.posexplode(popular_array(products, k)).alias("pos", PRODUCT))
    return listed.select(USER, (F.col("pos") + 1).alias("rank"), PRODUCT)


def cold_start_users(users: DataFrame, interactions: DataFrame) -> DataFrame:
    """Listed users without any interaction. One on unknown products only is not cold."""
    return users.join(interactions.select(USER).distinct(), USER, "left_anti")


def item_text(products: DataFrame) -> Column:
    """Name, category and description in one text; a column the table lacks counts as empty."""
    return joined_text(*(F.col(c) if c in products.columns else F.lit("") for c in TEXT_COLUMNS))


def fit_content(
    products: DataFrame, max_terms: int = tfidf.MAX_TERMS, stop_words: Sequence[str] | None = None
) -> tfidf.TfIdf:
    """The TF-IDF model of the catalogue's texts."""
    return tfidf.fit(products, PRODUCT, item_text(products), max_terms, stop_words)


def history_counts(users: DataFrame, interactions: DataFrame) -> DataFrame:
    """(user, product, n) of the listed users: repeats count, folded before any join.

    Written once: profiles are summed from it, and it says what to leave out.
    """
    folded = interactions.where(F.col(USER).isNotNull()).groupBy(USER, PRODUCT).agg(F.count(F.lit(1)).alias("n"))
    return spread(materialize(folded.join(users.select(USER), USER, "left_semi"), "history"))


def user_profiles(history: DataFrame, model: tfidf.TfIdf) -> DataFrame:
    """(user, idx, w): the sum of each user's history vectors, repeats included.

    Products outside the catalogue add nothing, but keep their user: the arrays
    are then empty. A profile has at most one entry per vocabulary term. The rows of a user
    meet in a sorted stream and are summed there, not entry by entry in a shuffle.
    """
    known, few = _with_history(history, model)
    # A row's vector travels only where the vectors of all products with history are too many to send to every task.
    if few:
        rows, vectors = history, shared_vectors(known, PRODUCT)
    else:
        rows, vectors = history.join(known, PRODUCT, "left"), None
    # The sort comes last: below a join Spark leaves it out.
    dealt = rows.repartition(USER).sortWithinPartitions(USER)
    return sum_runs(dealt, USER, PRODUCT, len(model.terms), vectors)


def _with_history(history: DataFrame, model: tfidf.TfIdf) -> tuple[DataFrame, bool]:
    """The vectors of the products with history, and whether they can be sent to every task."""
    known = model.vectors().join(history.select(PRODUCT).distinct(), PRODUCT, "left_semi")
    n_items, n_entries = known.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("idx")), F.lit(0))).first()
    return known, n_items * ID_BYTES + n_entries * ENTRY_BYTES <= BROADCAST_BYTES


def profile_queries(history: DataFrame, model: tfidf.TfIdf) -> Queries:
    """The users' profiles as queries that leave out their history.

    A profile has many times the bytes of its history: where tasks can have the vectors of all products with history, it
    is summed in the task that needs it (the sums of ``user_profiles``), and neither stored nor shuffled.
    """
    known, few = _with_history(history, model)
    if few:
        return summed(history, known, USER, PRODUCT, len(model.terms))
    seen = history.join(model.counts.select(PRODUCT), PRODUCT, "left_semi")
    return listed(materialize(user_profiles(history, model), "user-profiles"), seen, USER, PRODUCT, len(model.terms))


def ranked(scored: DataFrame, group: str, item: str, k: int) -> DataFrame:
    """(group, rank, item, score): the k best rows of each group by (score desc, item asc)."""
    best = Window.partitionBy(group).orderBy(F.desc("score"), item)
    rows = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return rows.select(group, "rank", item, "score")


def recommend_content(
    users: DataFrame, products: DataFrame, interactions: DataFrame, k: int = 5, model: tfidf.TfIdf | None = None,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Each listed user's k unseen products most like their history.

    Users without history get the popular products. A list that stays short,
    because the history covers the catalogue, is filled up with popular products
    not yet listed, history allowed; filled places score 0. ``broadcast_bytes`` is the
    size up to which item vectors are sent to every task (``scoring.best_items``).
    """
    model = fit_content(products) if model is None else model
    history = history_counts(users, interactions)
    asked = profile_queries(history, model)
    scored = best_items(asked, model.vectors(), USER, PRODUCT, len(model.terms), k, broadcast_bytes)
    listed = (
        ranked(scored, USER, PRODUCT, k)
        .groupBy(USER)
        .agg(F.array_sort(F.collect_list(F.struct("rank", PRODUCT, "score"))).alias("own"))  # k rows at most
    )
    slot = F.array().cast(listed.schema["own"].dataType)
    joined = users.select(USER).join(listed, USER, "left").select(
        USER, F.coalesce("own", slot).alias("own"), popular_array(products, k).alias("popular")
    )
    own_ids = joined.withColumn("ids", F.transform("own", lambda s: s[PRODUCT]))
    filled = own_ids.select(
        USER,
        F.slice(
            F.concat(
                F.transform("own", lambda s: F.struct(s[PRODUCT].alias(PRODUCT), s["score"].alias("score"))),
                F.transform(
                    F.array_except("popular", "ids"), lambda p: F.struct(p.alias(PRODUCT), F.lit(0.0).alias("score"))
                ),
            ),
            1,
            k,
        ).alias("list"),
    )
    out = filled.select(USER, F.posexplode("list").alias("pos", "p"))
    return out.select(USER, (F.col("pos") + 1).alias("rank"), f"p.{PRODUCT}", "p.score")


def similar_items(model: tfidf.TfIdf, k: int = 5, broadcast_bytes: int | None = None) -> DataFrame:
    """(product, rank, similar, score): each item's k nearest others by cosine."""
    itself = F.when(F.col(PRODUCT).isNotNull(), F.array(PRODUCT))
    rows = model.vectors().select(F.col(PRODUCT).alias("q"), itself.alias("seen"), "idx", "w")  # row by row from the stored counts
    scored = best_items(stored_vectors(rows, len(model.terms)), model.vectors(), "item_id", PRODUCT, len(model.terms), k, broadcast_bytes)
    out = ranked(scored, "item_id", PRODUCT, k)
    return out.select(F.col("item_id").alias(PRODUCT), "rank", F.col(PRODUCT).alias("similar_id"), "score")


def lookup(requests: DataFrame, recommendations: DataFrame, k: int = 5) -> DataFrame:
    """The stored lists of the requested users, cut to k; an unknown user has no rows."""
    return recommendations.where(F.col("rank") <= k).join(requests.select(USER).distinct(), USER, "left_semi")
