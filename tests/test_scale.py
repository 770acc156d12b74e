"""Plans that must hold at size, and results under a key that holds a third of the rows."""

import pytest
from pyspark.sql import functions as F

from basketry.operators import aggregates, dedup, encode, evaluate, holdout, integrity, quality, recommend
from basketry.session import materialize
from basketry.specs import DATASETS


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 reviews: user 0 has a third, product 1 another third, and a third of the sentiments are null."""
    i = F.col("id")
    return materialize(
        spark.range(3000).select(
            i.alias("review_id"),
            F.when(i % 3 == 0, 0).otherwise(i % 101).alias("user_id"),
            F.when(i % 3 == 1, 1).otherwise(i % 53).alias("product_id"),
            F.when(i % 7 == 0, None).otherwise((i % 5 + 1) * 1.0).alias("rating"),
            F.when(i % 3 == 2, None).otherwise(F.concat(F.lit("s"), i % 4)).alias("sentiment"),
            F.date_add(F.lit("2024-01-01").cast("date"), (i % 400).cast("int")).cast("timestamp").alias("review_date"),
        ),
        "skewed",
    )


@pytest.fixture(scope="module")
def local(skewed):
    return skewed.toPandas()


def test_holdout_folds_before_the_shuffle(skewed, local):
    test = holdout.last_interactions(skewed, "user_id", "review_date", "review_id")
    assert "partial_max_by" in plan(test)
    last = local.sort_values(["user_id", "review_date", "review_id"]).groupby("user_id").tail(1)
    many = local.groupby("user_id")["review_id"].transform("size") >= 2
    assert [r[0] for r in rows(test.select("review_id"), "review_id")] == sorted(last[many.loc[last.index]]["review_id"])


def test_train_and_test_are_the_whole(skewed):
    train, test = holdout.train_test(skewed, "user_id", "review_date", "review_id")
    both = train.unionByName(test)
    assert both.count() == skewed.count() and both.exceptAll(skewed).isEmpty()


def test_keep_first_of_a_hot_key(skewed, local):
    first = dedup.keep_first(skewed, ["user_id"], [F.desc("review_id")])
    assert plan(first).count("WindowGroupLimit") == 2
    expected = local.groupby("user_id")["review_id"].max()
    assert rows(first.select("user_id", "review_id"), "user_id") == list(expected.items())


def test_features_of_hot_keys(skewed, local):
    products = skewed.select("product_id").distinct()
    got = rows(aggregates.product_features(products, skewed), "product_id")
    expected = local.groupby("product_id").agg(m=("rating", "mean"), n=("review_id", "size"))
    assert [(p, n) for p, _, n in got] == list(expected["n"].items())
    assert all(abs(m - e) < 1e-9 for (_, m, _), e in zip(got, expected["m"]))


def test_foreign_keys_meet_as_distinct_keys(spark, skewed):
    dim = skewed.select("user_id").distinct().where("user_id != 0")
    audit = integrity.foreign_key(skewed, "user_id", dim, "user_id")
    hot = skewed.where("user_id = 0").count()
    assert hot > 1000 and rows(audit, "key") == [(0, hot)]
    # A small dimension is broadcast to the scan; a large one meets the folded keys.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = plan(integrity.foreign_key(skewed, "user_id", dim, "user_id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert shuffled.index("SortMergeJoin") < shuffled.index("HashAggregate")


def test_codes_of_a_hot_null(skewed):
    coded = encode.label_encode(skewed, {"sentiment": "code"}, max_bytes=0)
    assert coded.count() == 3000
    pairs = {(r.sentiment, r.code) for r in coded.select("sentiment", "code").distinct().collect()}
    assert pairs == {(None, -1), ("s0", 0), ("s1", 1), ("s2", 2), ("s3", 3)}


def test_report_shuffles_digests_only(skewed):
    report = quality.quality_report(skewed.withColumn("review_text", F.repeat(F.lit("x"), 5000)), DATASETS["reviews"])
    exchange = next(line for line in plan(report).splitlines() if "Exchange hashpartitioning" in line)
    assert "review_text" not in exchange and "_m0" in exchange


def test_popular_lists_do_not_shuffle_users(spark, sf_dir):
    from basketry.plans.adapters import table

    users = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    stats = spark.createDataFrame([(1, 2, 3.0)], "product_id long, item_interaction_count long, item_avg_rating double")
    assert "Exchange" not in plan(recommend.recommend_popular(users, stats, 5)).split("Subquery")[0]


def test_scan_reads_needed_columns_and_filters(spark, sf_dir):
    from basketry.operators.impute import drop_missing
    from basketry.plans.adapters import table

    scan = plan(drop_missing(table(spark, sf_dir, "events"), ["user_id"]).select("value"))
    assert "IsNotNull(user_id)" in scan and "props" not in scan


def test_metrics_of_a_hot_user(spark, skewed):
    lists = spark.range(101).select(F.col("id").alias("user_id"), F.explode(F.sequence(F.lit(1), F.lit(3))).alias("rank"))
    lists = lists.withColumn("product_id", F.col("rank").cast("long"))
    per_user = evaluate.user_metrics(skewed, lists, 3)
    hot = per_user.where("user_id = 0").first()
    true = skewed.where("user_id = 0").select("product_id").distinct().count()
    assert abs(hot.recall - 3 / true) < 1e-12 and hot.precision == 1.0 and abs(hot.ndcg - 1) < 1e-12
    assert "Join" not in plan(per_user)
