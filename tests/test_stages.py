"""The whole flow over CSV files shaped like the data contract."""

import csv

import pytest
from pyspark.sql import functions as F

from basketry.operators.integrity import IntegrityError
from basketry.plans import stages
from basketry.session import work_path
from basketry.sources import landing, zones
from basketry.streaming import clickstream

DAY = "2024-05-01"


def write(path, header, data):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(header.split())
        out.writerows(data)
    return str(path)


@pytest.fixture(scope="module")
def sources(tmp_path_factory):
    root = tmp_path_factory.mktemp("csv")
    genders = ["F", "M", ""]
    kinds = ["tea pot", "tea cup", "red shoe", "blue shoe"]
    return {
        "users": write(
            root / "users.csv",
            "user_id age gender city membership preferred_category signup_date customer_segment is_active",
            [(f"u{i}", "" if i % 5 == 0 else 20 + i, genders[i % 3], "Oslo", "gold", "x", f"2023-0{1 + i % 9}-10", "new", "True") for i in range(20)],
        ),
        "products": write(
            root / "products.csv",
            "product_id product_name category brand price avg_rating rating_count availability bestseller_rank description",
            [(f"p{i}", f"{kinds[i % 4]} {i}", "" if i == 3 else "home", "b", "" if i % 4 == 0 else 10.5 * i, "4.6 out of 5 stars", 3, "yes", "",
              f'A {kinds[i % 4]},\nwith "style"') for i in range(12)],
        ),
        "reviews": write(
            root / "reviews.csv",
            "review_id user_id product_id rating review_text sentiment verified_purchase review_date",
            [(f"r{i}", f"u{i % 15}", f"p{(i * 5) % 12}", "" if i % 9 == 0 else 1 + i % 5, f"text {i}", ["pos", "neg"][i % 2], "True",
              "" if i % 11 == 0 else f"2024-01-{1 + i % 28:02d}") for i in range(60)],
        ),
        "sessions": write(
            root / "sessions.csv",
            "session_id user_id session_start session_end device browser traffic_source session_duration_sec pages_visited bounce conversion",
            [(f"s{i}", f"u{i % 10}", "x", "y", "mobile", "ff", "ad", i * 10, 3, "False", "False") for i in range(40)],
        ),
        "clickstream": write(
            root / "clickstream.csv",
            "event_id session_id user_id product_id event_timestamp event_type page device browser traffic_source dwell_time_sec recommendation_flag",
            [(f"e{i}", f"s{i % 40}", f"u{i % 10}", f"p{i % 12}", f"2024-01-01 {i % 24:02d}:00:00", ["view", "click"][i % 2], "home", "mobile", "ff",
              "ad", i - 3, "0") for i in range(100)],
        ),
        "returns": str(root / "absent.csv"),
    }


@pytest.fixture(scope="module")
def lake(spark, sources):
    path = work_path(spark, "lake")
    metrics = stages.ingest(spark, sources, path, DAY)
    assert {r.dataset: (r.ok, r.n_rows) for r in metrics.collect()} == {
        "users": (True, 20), "products": (True, 12), "reviews": (True, 60), "sessions": (True, 40),
        "clickstream": (True, 100), "returns": (False, 0),
    }
    return path


@pytest.fixture(scope="module")
def prepared(spark, lake):
    report, gate = stages.validate(spark, lake)
    assert all(r.promoted for r in gate.collect()), rows(report.where("NOT passed"))
    assert sorted(stages.prepare_all(spark, lake)) == ["clickstream", "products", "reviews", "sessions", "users"]
    return lake


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_prepared_tables(spark, prepared):
    users = zones.read_table(spark, f"{prepared}/processed", "users")
    median = 30.0  # between 29 and 31, the middle of 21..24, 26..29, 31..34, 36..39
    first = users.where("user_id = 'u0'").first()
    assert (first.age, first.gender, first.signup_year, first.signup_month) == (median, "F", 2023, 1)
    assert {r.gender: r.gender_encoded for r in users.collect()} == {"F": 0, "M": 1, "Unknown": 2}
    products = zones.read_table(spark, f"{prepared}/processed", "products")
    assert {r.avg_rating for r in products.collect()} == {4.6}
    assert products.where("product_id = 'p3'").first().category_encoded == -1
    reviews = zones.read_table(spark, f"{prepared}/processed", "reviews")
    assert reviews.where("review_id = 'r9'").first().rating == 3.0
    clicks = zones.read_table(spark, f"{prepared}/processed", "clickstream")
    assert clicks.where("event_id = 'e0'").first().dwell_time_sec == 0.0
    assert clicks.where("event_id = 'e5'").first().event_hour == 5


def test_warehouse_features_and_training(spark, prepared):
    counts = dict(rows(stages.load_warehouse(spark, prepared)))
    assert counts == {"dim_users": 20, "dim_products": 12, "fact_interactions": 60}
    registry = stages.materialize_features(spark, prepared, "v1", "2024-05-01T00:00:00")
    assert registry.count() == 12 and registry.where("latest_version = 'v1'").count() == 12
    report = {r.model: r for r in stages.train(spark, prepared, "run1").collect()}
    assert set(report) == {"popularity", "content_tfidf"} and report["popularity"].n_users == 15
    stored = zones.read_table(spark, f"{prepared}/recommendations", "content")
    assert stored.groupBy("user_id").count().where("count != 5").isEmpty() and stored.select("user_id").distinct().count() == 20
    assert spark.read.parquet(f"{prepared}/reports/metrics").count() == 6
    assert rows(spark.read.parquet(f"{prepared}/reports/runs")) == [("run1", "per-user holdout", 5, 45, 15, 15)]
    assert spark.read.json(f"{prepared}/reports/evaluation_json").count() == 2
    asked = spark.createDataFrame([("u3",), ("nobody",)], "user_id string")
    assert [r.rank for r in stages.recommend_for(spark, prepared, asked, 2).orderBy("rank").collect()] == [1, 2]
    with pytest.raises(FileNotFoundError):
        stages.recommend_for(spark, work_path(spark, "lake"), asked)
    audit = {(r.track, r.stage): (r.n_rows, r.n_keys) for r in stages.audit_stages(spark, prepared).collect()}
    assert audit[("users", "processed")] == (20, 20) and audit[("fact_interactions", "warehouse")] == (60, 60)


def test_chart_datasets(spark, prepared):
    charts = stages.explore(spark, prepared)
    assert sum(r.n for r in charts["rating_histogram"].collect()) == 53
    assert charts["item_popularity"].count() == 12
    assert charts["sparsity"].first().n_users == 15


def test_failed_dataset_is_not_promoted(spark, lake, sources, tmp_path):
    other = work_path(spark, "lake")
    bad = write(tmp_path / "users.csv", "user_id age", [("u1", 300), ("", 20)])
    stages.ingest(spark, {"users": bad, "sessions": sources["sessions"]}, other, DAY)
    report, gate = stages.validate(spark, other)
    verdict = {r.dataset: (r.schema_ok, r.quality_ok) for r in gate.collect()}
    assert verdict == {"users": (False, False), "sessions": (True, True)}
    assert zones.existing(spark, f"{other}/validated", ["users", "sessions"]) == ["sessions"]
    with pytest.raises(FileNotFoundError, match="users"):
        stages.prepare_all(spark, other)
        stages.load_warehouse(spark, other)


def test_broken_key_stops_the_load(spark, prepared):
    other = work_path(spark, "lake")
    for name in ("users", "products", "reviews", "sessions"):
        df = zones.read_table(spark, f"{prepared}/processed", name)
        zones.write_table(df.where("user_id != 'u3'") if name == "users" else df, f"{other}/processed", name)
    with pytest.raises(IntegrityError, match="foreign key user_id"):
        stages.load_warehouse(spark, other)
    assert zones.existing(spark, f"{other}/warehouse", ["dim_users"]) == []


def test_stream_equals_batch(spark, prepared):
    batch = zones.read_table(spark, f"{prepared}/processed", "clickstream")
    codes = batch.select(F.col("event_type").alias("value"), F.col("event_type_encoded").alias("code")).distinct()
    raw = landing.read_latest(spark, f"{prepared}/raw/clickstream").drop("ingest_seq")
    path, out = work_path(spark, "stream-in"), work_path(spark, "stream-out")
    raw.unionByName(raw.limit(10)).write.parquet(path)
    stream = clickstream.read_events(spark, path, raw.schema)
    query = clickstream.write_events(clickstream.prepare_events(stream, codes), out, work_path(spark, "stream-check"))
    assert query.awaitTermination(120)
    got = spark.read.parquet(out).select(batch.columns)
    assert rows(got, "event_id") == rows(batch, "event_id")
