import pytest

from basketry.operators import feature_store, integrity, quality
from basketry.plans import warehouse
from basketry.session import work_path
from basketry.specs import DatasetSpec, FeatureView, RangeRule

VIEW = FeatureView("v", "t", "id", "", (("a", "REAL"), ("b", "TEXT"), ("absent", "TEXT")))


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_unpivot(spark):
    df = spark.createDataFrame([(1, 41.0, None), (2, None, "x")], "id int, a double, b string")
    got = {(r[1], r[2]): r[3] for r in rows(feature_store.unpivot_view(df, VIEW, "v1", "t1"))}
    assert got == {
        ("1", "a"): "41.0", ("1", "b"): "None", ("1", "absent"): "",
        ("2", "a"): "None", ("2", "b"): "x", ("2", "absent"): "",
    }


@pytest.fixture
def written(spark):
    path = work_path(spark, "store")

    def write(data, version, at):
        df = spark.createDataFrame(data, "id int, a double, b string")
        feature_store.write_features(feature_store.unpivot_view(df, VIEW, version, at), path)

    return path, write


def test_same_version_twice(spark, written):
    path, write = written
    write([(1, 1.0, "x"), (2, 2.0, "y")], "v1", "t1")
    write([(1, 5.0, "x")], "v1", "t2")
    store = feature_store.read_features(spark, path)
    assert store.count() == 6
    got = {r[1]: r[3] for r in rows(store) if r[2] == "a"}
    assert got == {"1": "5.0", "2": "2.0"}


def test_latest_follows_time_not_version(spark, written):
    path, write = written
    write([(1, 1.0, "x")], "v1", "t1")
    write([(1, 2.0, "x")], "v2", "t2")
    write([(1, 3.0, "x")], "v1", "t3")
    store = feature_store.read_features(spark, path)
    latest = {r[2]: (r[3], r[4]) for r in rows(feature_store.lookup_latest(store, "v", "1"))}
    assert latest["a"] == ("3.0", "v1")
    assert {r[2]: r[3] for r in rows(feature_store.lookup_version(store, "v2", "v", "1"))}["a"] == "2.0"
    assert rows(feature_store.lookup_latest(store, "v", "9")) == []
    wide = feature_store.wide_features(feature_store.lookup_latest(store), VIEW)
    assert rows(wide) == [("1", "3.0", "x", "")]
    entry = rows(feature_store.registry(store, [VIEW], spark).select("feature", "latest_version", "last_materialized_at"), "feature")
    assert entry == [("a", "v1", "t3"), ("absent", "v1", "t3"), ("b", "v1", "t3")]


def test_no_store_yet(spark):
    assert feature_store.read_features(spark, work_path(spark, "none")) is None


def test_report_finds_each_kind_of_issue(spark):
    spec = DatasetSpec(
        "users", ("id", "age", "gone"), "id", ("id", "gone"), (RangeRule("age", 0, 120),), email_column="email"
    )
    df = spark.createDataFrame(
        [("1", "30", "a@b"), ("1", "30", "a@b"), (None, "200", "ab"), ("3", "old", None), ("4", None, "x@y")],
        "id string, age string, email string",
    )
    report = quality.quality_report(df, spec)
    got = {(r[1], r[2]): (r[3], r[4]) for r in rows(report)}
    assert got == {
        ("rows", "*"): (5, True), ("duplicates", "*"): (1, False),
        ("nulls", "id"): (1, True), ("nulls", "age"): (1, True), ("nulls", "email"): (1, True),
        ("required", "id"): (1, False), ("required", "gone"): (5, False),
        ("malformed", "age"): (1, False), ("range", "age"): (1, False), ("email", "email"): (2, False),
    }
    assert rows(quality.verdicts(report)) == [("users", 6, False)]
    assert rows(quality.rule_counts(df, spec, "range")) == [("users", "age", 1)]
    assert quality.missing_columns(df, spec) == ["gone"] and quality.missing_columns(df, None) == []


def test_report_of_a_wide_table(spark):
    columns = [f"c{i}" for i in range(150)]
    df = spark.createDataFrame([tuple(None if i % 2 else i for i in range(150))] * 3, ", ".join(f"{c} int" for c in columns))
    report = quality.quality_report(df, DatasetSpec("wide", (), "c0", ()))
    nulls = {r[2]: r[3] for r in rows(report) if r[1] == "nulls"}
    assert nulls == {c: 3 * (i % 2) for i, c in enumerate(columns)}


def test_constraints(spark):
    dims = {
        "dim_users": spark.createDataFrame([("u", 1, 0.0)], "user_id string, user_activity_frequency long, user_avg_rating double"),
        "dim_products": spark.createDataFrame(
            [("p", "n", 0.0, 0)], "product_id string, product_name string, item_avg_rating double, item_interaction_count long"
        ),
    }
    good = spark.createDataFrame([("r", "u", "p", 4.0)], "review_id string, user_id string, product_id string, rating double")
    integrity.require_clean(warehouse.audits({**dims, "fact_interactions": good}))
    bad = spark.createDataFrame(
        [("r", "u", "p", 9.0), ("r", "x", "p", None)], "review_id string, user_id string, product_id string, rating double"
    )
    with pytest.raises(integrity.IntegrityError) as error:
        integrity.require_clean(warehouse.audits({**dims, "fact_interactions": bad}))
    for part in ("primary key review_id: 1", "foreign key user_id: 1", "not null: 1", "rating bounds: 1"):
        assert part in str(error.value)


ROW = "feature_view string, entity_id string, attribute_name string, attribute_value string, feature_version string, materialized_at string"


def test_last_row_of_a_key_wins(spark):
    path = work_path(spark, "store")
    batch = [("v", "1", "a", "x", "v1", "t1"), ("v", "1", "a", "y", "v1", "t2"), ("v", "1", "a", "w", "v1", "t2"), ("v", "1", "b", "z", "v1", "t1")]
    feature_store.write_features(spark.createDataFrame(batch, ROW), path)
    feature_store.write_features(spark.createDataFrame([("v", "1", "b", "q", "v1", "t3")] * 3, ROW), path)
    assert rows(feature_store.read_features(spark, path), "attribute_name") == [
        ("v", "1", "a", "y", "v1", "t2"), ("v", "1", "b", "q", "v1", "t3"),
    ]
    assert integrity.primary_key(feature_store.read_features(spark, path), feature_store.KEYS).isEmpty()
    assert rows(feature_store.upsert(spark.createDataFrame([], ROW), spark.createDataFrame(batch, ROW)), "attribute_name") == [
        ("v", "1", "a", "y", "v1", "t2"), ("v", "1", "b", "z", "v1", "t1"),
    ]


def test_repeated_entities_by_order(spark):
    df = spark.createDataFrame([(1, 2.0, "old", 1), (1, None, "new", 2), (None, 3.0, "n", 1)], "id int, a double, b string, at int")
    got = rows(feature_store.unpivot_view(df, VIEW, "v1", "t1", order=["at"]), "entity_id", "attribute_name")
    assert [(r[1], r[2], r[3]) for r in got] == [
        ("1", "a", "None"), ("1", "absent", ""), ("1", "b", "new"), ("None", "a", "3.0"), ("None", "absent", ""), ("None", "b", "n"),
    ]


def brute_latest(history):
    """Rows of the greatest time of each (view, entity); one value an attribute, of the greatest version."""
    out = {}
    for view, entity, attribute, value, version, at in history:
        last = max(r[5] for r in history if r[:2] == (view, entity))
        if at == last:
            key = (view, entity, attribute)
            out[key] = max(out.get(key, ("",)), (version, value))
    return sorted((*k, value, version) for k, (version, value) in out.items())


def test_current_state_follows_the_history(spark):
    """Random batches, also with times that go back, so that an older version becomes the last again."""
    import random

    rng = random.Random(11)
    path, history = work_path(spark, "store"), {}
    for n in range(9):
        batch = {}
        for _ in range(rng.randrange(1, 12)):
            key = (rng.choice("vw"), rng.choice("123"), rng.choice("ab"), rng.choice(["v1", "v/2 =%", "v3"]))
            batch[key] = (f"x{n}", f"t{rng.randrange(5)}")
        feature_store.write_features(spark.createDataFrame([(*k, v, t) for k, (v, t) in batch.items()], "feature_view string, entity_id string, attribute_name string, feature_version string, attribute_value string, materialized_at string").select(*feature_store.COLUMNS), path)
        history.update(batch)
        flat = [(k[0], k[1], k[2], v, k[3], t) for k, (v, t) in history.items()]
        assert sorted(map(tuple, feature_store.read_features(spark, path).collect())) == sorted(flat)
        assert sorted(map(tuple, feature_store.latest(spark, path).collect())) == brute_latest(flat), n
    current = feature_store.read_current(spark, path)
    assert current.count() == current.select("feature_view", "entity_id").distinct().count()


def test_retrieve(spark, written):
    path, write = written
    write([(1, 1.0, "x"), (2, 1.0, "x")], "v1", "t1")
    write([(1, 2.0, "y")], "v2", "t2")
    assert dict(rows(feature_store.retrieve(spark, path, "v", "1"))) == {"a": "2.0", "b": "y", "absent": ""}
    assert dict(rows(feature_store.retrieve(spark, path, "v", "1", "v1"))) == {"a": "1.0", "b": "x", "absent": ""}
    assert rows(feature_store.retrieve(spark, path, "v", "2", "v2")) == [] and rows(feature_store.retrieve(spark, path, "w", "1")) == []
    plan = feature_store.latest(spark, path, "v", "1")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(entity_id,1)" in plan and "Window" not in plan and "Exchange" not in plan


def test_failed_write_leaves_the_store(spark, written):
    from pyspark.sql import functions as F

    path, write = written
    write([(1, 1.0, "x")], "v1", "t1")
    bad = feature_store.read_features(spark, path).withColumn("attribute_value", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        feature_store.write_features(bad, path)
    assert feature_store.read_features(spark, path).count() == 3 and feature_store.latest(spark, path).count() == 3


def test_store_of_partition_folders_is_taken_over(spark):
    path = work_path(spark, "store")
    old = spark.createDataFrame([("v", "1", "a", "x", "v1", "t1"), ("v", "1", "a", "y", "v2", "t2")], ROW)
    old.write.partitionBy("feature_view", "feature_version").parquet(path)
    assert feature_store.read_features(spark, path).count() == 2
    feature_store.write_features(spark.createDataFrame([("v", "2", "a", "z", "v1", "t3")], ROW), path)
    assert feature_store.read_features(spark, path).count() == 3
    assert rows(feature_store.latest(spark, path), "entity_id") == [("v", "1", "a", "y", "v2"), ("v", "2", "a", "z", "v1")]
