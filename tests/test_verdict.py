"""Inputs that small uniform data does not show: changed schemas, empty days, NaN, nested values, null means."""

import pytest
from pyspark.sql import functions as F

from basketry.operators import dedup, encode, impute, profile, recommend
from basketry.plans import prepare, stages
from basketry.sources import landing, zones


def test_newest_landing_has_its_own_columns(spark, tmp_path):
    path = str(tmp_path / "users")
    landing.land(spark.createDataFrame([(1, "a", 2)], "user_id int, city string, age int"), path, "2024-01-01")
    landing.land(spark.createDataFrame([(5, "x")], "user_id int, extra string"), path, "2024-01-02")
    latest = landing.read_latest(spark, path)
    assert latest.columns == ["user_id", "extra"] and latest.count() == 1
    landing.land(latest.where("false"), path, "2024-01-03")
    assert landing.read_latest(spark, path).count() == 0
    landing.land(latest.where("false"), path, "2024-01-02")
    assert spark.read.parquet(f"{path}/ingest_date=2024-01-02").count() == 0
    with pytest.raises(FileNotFoundError):
        (tmp_path / "none").mkdir()
        landing.read_latest(spark, str(tmp_path / "none"))


def test_failed_write_keeps_the_older_table(spark, tmp_path):
    root = str(tmp_path)
    zones.write_table(spark.range(3), root, "t")
    with pytest.raises(Exception):
        zones.write_table(spark.range(9).select(F.raise_error(F.lit("stop")).cast("long").alias("id")), root, "t")
    assert zones.read_table(spark, root, "t").count() == 3
    own = zones.read_table(spark, root, "t")
    zones.write_table(own.where("id > 0"), root, "t")  # from itself
    assert zones.read_table(spark, root, "t").count() == 2


def test_nan_is_null_in_median_and_scaling(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "x double")
    assert [r.x for r in impute.median_impute(df, ["x"]).collect()] == [1.0, 2.0, 1.5, 1.5]
    assert df.select(impute.median_column(df, "x", 10**9).alias("m")).first().m == 1.5
    assert [r.y for r in encode.minmax_scale(df, {"x": "y"}).collect()] == [0.0, 1.0, None, None]


def test_nested_values_are_not_copies(spark):
    df = spark.createDataFrame([(["a, b"],), (["a", "b"],), (["a", "b"],)], "v array<string>")
    assert dedup.duplicate_rows(df).first().duplicate_rows == 1


def test_popularity_with_a_null_mean(spark):
    products = spark.createDataFrame([("b", 3, None), ("a", 3, 1.0), ("c", 1, 5.0)], "product_id string, item_interaction_count long, item_avg_rating double")
    listed = [r.product_id for r in recommend.popular_products(products, 3).collect()]
    users = spark.createDataFrame([("u",)], "user_id string")
    assert listed == [r.product_id for r in recommend.recommend_popular(users, products, 3).orderBy("rank").collect()] == ["a", "b", "c"]


def test_content_hash_sees_swapped_columns(spark):
    one, two = (spark.createDataFrame([r], "a int, b int, v string") for r in ((1, None, "v"), (None, 1, "v")))
    audits = [profile.stage_audit([("t", "s", df, "v")]).first().content_hash for df in (one, two)]
    assert audits[0] != audits[1]


def test_clickstream_format_from_linked_rows(spark):
    rows = [("e1", None, "u", "p", "01/02/2024", "view", "1", 1), ("e2", "s", "u", "p", "2024-01-02 10:00:00", "view", "1", 2)]
    df = spark.createDataFrame(rows, "event_id string, session_id string, user_id string, product_id string, event_timestamp string, event_type string, dwell_time_sec string, ingest_seq int")
    assert [r.event_hour for r in prepare.prepare_clickstream(df, ["ingest_seq"]).collect()] == [10]


def test_payload_failure_is_a_row(spark, tmp_path):
    (tmp_path / "a.csv").write_text("user_id\n1\n")
    got = {r.dataset: r.ok for r in stages.ingest(spark, {"users": str(tmp_path / "a.csv")}, str(tmp_path / "lake"), "2024-01-01", str(tmp_path / "gone")).collect()}
    assert got == {"users": True, "payloads": False}
