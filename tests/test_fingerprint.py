import pytest
from pyspark.sql import functions as F

from basketry.operators import encode, fingerprint, profile, recommend
from basketry.operators.aggregates import product_features
from basketry.session import work_path
from basketry.functions import temporal
from basketry.sources import files, landing

NAN = float("nan")


def table(spark):
    return spark.range(5000).select("id", (F.col("id") % 7).alias("a"), F.when(F.col("id") % 3 == 0, None).otherwise("x").alias("b"))


def test_levels_add_up(spark):
    tree = fingerprint.hash_tree(table(spark), "id")
    sums = tree.groupBy("level").agg(F.sum("n_rows").alias("n"), F.sum("content").alias("c"), F.count("*").alias("nodes")).orderBy("level").collect()
    assert [r.n for r in sums] == [5000] * 4 and len({r.c for r in sums}) == 1
    assert sums[0].nodes == 1 and sums[1].nodes == 16


def test_a_changed_cell_is_located(spark):
    df = table(spark)
    other = df.where("id != 11").withColumn("a", F.when(F.col("id") == 42, 99).otherwise(F.col("a"))).withColumn(
        "b", F.when(F.col("id") == 43, None).when(F.col("id") == 44, "").otherwise(F.col("b"))
    )
    other = other.unionByName(spark.createDataFrame([(9000, 1, "n")], "id long, a long, b string"))
    nodes = fingerprint.differing_nodes(fingerprint.hash_tree(df, "id"), fingerprint.hash_tree(other, "id"))
    assert nodes.where("level = 0").count() == 1 and 1 <= nodes.where("level = 3").count() <= 5
    got = {r.id: (r.kind, r.changed) for r in fingerprint.changed_keys(df, other, "id", ["a", "b"]).collect()}
    assert got == {11: ("removed", ""), 42: ("changed", "a"), 43: ("changed", "b"), 44: ("changed", "b"), 9000: ("added", "")}
    assert fingerprint.changed_keys(df, df.orderBy(F.desc("id")), "id", ["a", "b"]).collect() == []


def test_repeats_nulls_and_types(spark):
    before = spark.createDataFrame([(1, 1.0), (1, 1.0), (None, 2.0)], "id int, a double")
    after = spark.createDataFrame([(1, 1), (None, 3)], "id long, a int")
    got = {r.id: (r.kind, r.changed) for r in fingerprint.changed_keys(before, after, "id", ["a"]).collect()}
    assert got == {1: ("changed", "a"), None: ("changed", "a")}
    assert fingerprint.changed_keys(before.limit(0), before.limit(0), "id", ["a"]).collect() == []


def test_nan_counts_as_null(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 5.0), (4, NAN), (5, None)], "id int, x double")
    bins = profile.histogram(df, "x").orderBy("bin").collect()
    assert [r.n for r in bins] == [1, 1, 0, 0, 1] and (bins[0].low, bins[-1].high) == (1.0, 5.0)
    for limit in (1 << 20, -1):  # both dictionaries
        assert {r.id: r.c for r in encode.label_encode(df, {"x": "c"}, limit).collect()} == {1: 0, 2: 1, 3: 2, 4: -1, 5: -1}
    words = spark.createDataFrame([("NaN",), ("b",), (None,)], "x string")  # text is no number
    assert {r.x: r.c for r in encode.label_encode(words, {"x": "c"}).collect()} == {"NaN": 0, "b": 1, None: -1}
    assert {r.id: r.y for r in encode.log_scale(df, {"x": "y"}).where("id > 3").collect()} == {4: None, 5: None}
    stats = spark.createDataFrame([("a", 3, 1.0), ("b", 3, NAN), ("c", 3, None), ("d", 1, 5.0)], "product_id string, item_interaction_count long, item_avg_rating double")
    assert [r.product_id for r in recommend.popular_products(stats, 4).collect()] == ["a", "b", "c", "d"]
    listed = recommend.recommend_popular(spark.createDataFrame([("u",)], "user_id string"), stats, 4).orderBy("rank")
    assert [r.product_id for r in listed.collect()] == ["a", "b", "c", "d"]
    reviews = spark.createDataFrame([("a", 4.0), ("a", NAN), ("b", NAN)], "product_id string, rating double")
    means = product_features(stats.select("product_id"), reviews)
    assert {r.product_id: (r.item_avg_rating, r.item_interaction_count) for r in means.collect()} == {
        "a": (4.0, 2), "b": (0.0, 1), "c": (0.0, 0), "d": (0.0, 0),
    }


def test_dates_in_a_given_format(spark):
    df = spark.createDataFrame([(1, "03. Jan 2024"), (2, "04. Feb 2024"), (3, "2024-01-01"), (4, None)], "i int, x string")
    (lost,) = temporal.date_losses(df, ["x"], ["i"]).collect()
    assert tuple(lost) == ("x", None, 3, 2)  # no known format fits the first value, so each value is tried
    (lost,) = temporal.date_losses(df, ["x"], ["i"], ["dd. MMM yyyy"]).collect()
    assert tuple(lost) == ("x", "dd. MMM yyyy", 3, 1)
    days = df.select(temporal.parse_datetime(df, "x", None, ["dd. MMM yyyy"]).cast("date").cast("string").alias("d"))
    assert [r.d for r in days.collect()] == ["2024-01-03", "2024-02-04", None, None]


def test_payload_lanes(spark):
    path = work_path(spark, "payloads")
    texts = ['{"products": [1, {"a": 2}]}', "[1,2,3]", '{"products": 7}', '{"cut": [', "", "7", None]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, payload string")
    landing.land_parsed(df, path, "2024-01-01")
    rows = {r.n: (r.items, r.unparsed) for r in landing.read_latest(spark, path).select("n", files.parsed_item_count(F.col("value")).alias("items"), "unparsed").collect()}
    assert rows == {0: (2, None), 1: (3, None), 2: (0, None), 3: (0, '{"cut": ['), 4: (0, ""), 5: (0, None), 6: (0, None)}
    plain = df.select("n", files.payload_item_count(F.col("payload")).alias("items")).collect()
    assert {r.n: r.items for r in plain} == {n: items for n, (items, _) in rows.items()}


def test_exploration_summary(spark):
    reviews = spark.createDataFrame([("u", "p"), ("u", "q"), ("v", "p"), (None, "p")], "user_id string, product_id string")
    (row,) = profile.exploration_summary(reviews, spark.range(9)).collect()
    assert tuple(row)[:4] == (4, 9, 2, 2) and row.sparsity == pytest.approx(0.0)
    (row,) = profile.exploration_summary(reviews.limit(0), spark.range(0)).collect()
    assert tuple(row) == (0, 0, 0, 0, None)
