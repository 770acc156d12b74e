import pytest
from pyspark.sql import functions as F

from basketry.operators.integrity import IntegrityError
from basketry.plans import stages, warehouse
from basketry.session import work_path
from basketry.sources import commits, landing, zones
from basketry.sources.publish import filesystem


def ids(df):
    return sorted(r[0] for r in df.collect())


def broken(spark):
    return spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).alias("id"))


def test_a_set_changes_at_once(spark):
    """A job that dies between two tables leaves the old set, whole and readable."""
    root = work_path(spark, "zone")
    zones.write_tables({"a": spark.range(1), "b": spark.range(2)}, root)
    with pytest.raises(Exception, match="stop"):
        zones.write_tables({"a": spark.range(10), "b": broken(spark)}, root)
    old = zones.require_tables(spark, root, ["a", "b"])
    assert (ids(old["a"]), ids(old["b"])) == ([0], [0, 1])
    zones.write_tables({"a": spark.range(3), "b": zones.read_table(spark, root, "b").where("id > 0")}, root)
    # Tables opened before the change still read their own version.
    assert (ids(old["a"]), ids(old["b"])) == ([0], [0, 1])
    new = zones.require_tables(spark, root, ["a", "b"])
    assert (ids(new["a"]), ids(new["b"])) == ([0, 1, 2], [1])
    zones.write_table(spark.range(1), root, "c")  # others keep theirs
    assert ids(zones.read_table(spark, root, "a")) == [0, 1, 2]


def test_staged_versions_are_not_seen(spark):
    root = work_path(spark, "zone")
    zones.write_table(spark.range(1), root, "a")
    staged = commits.stage({"a": spark.range(5), "b": spark.range(6)}, root)
    assert ids(zones.read_table(spark, root, "a")) == [0] and zones.read_table(spark, root, "b") is None
    assert zones.existing(spark, root, ["a", "b"]) == ["a"]
    assert commits.commit(spark, root, staged) == 2
    assert zones.read_table(spark, root, "a").count() == 5 and zones.existing(spark, root, ["a", "b"]) == ["a", "b"]
    assert commits.commit(spark, root, {}, drop=("b",)) == 3 and zones.existing(spark, root, ["a", "b"]) == ["a"]


def test_two_writers(spark, monkeypatch):
    """The later one finds its number taken and commits on top of the other's record."""
    root = work_path(spark, "zone")
    zones.write_table(spark.range(1), root, "a")
    seen = commits.head(spark, root)
    zones.write_table(spark.range(2), root, "b")  # the other writer
    real, stale = commits.head, [seen]
    monkeypatch.setattr(commits, "head", lambda s, r: stale.pop() if stale else real(s, r))
    assert commits.publish(spark, {"c": spark.range(3)}, root) == 3
    assert sorted(commits.head(spark, root)[1]) == ["a", "b", "c"]
    names = [s.getPath().getName() for s in filesystem(spark, root)[1].listStatus(filesystem(spark, f"{root}/_commits")[0])]
    assert sorted(n for n in names if not n.startswith(".")) == [f"{n:012d}.json" for n in (1, 2, 3)]


def test_a_record_cut_short_does_not_count(spark):
    root = work_path(spark, "zone")
    zones.write_table(spark.range(1), root, "a")
    for number, text in ((2, '{"tables": {"a": "_vers'), (3, ""), (4, '{"tables": {}}')):
        place, fs = filesystem(spark, f"{root}/_commits/{number:012d}.json")
        out = fs.create(place, False)
        out.write(bytearray(text, "utf-8"))
        out.close()
    assert ids(zones.read_table(spark, root, "a")) == [0]
    assert commits.publish(spark, {"a": spark.range(2)}, root) == 5 and ids(zones.read_table(spark, root, "a")) == [0, 1]


def test_history_and_vacuum(spark):
    root = work_path(spark, "zone")
    for n in range(1, 5):
        zones.write_tables({"a": spark.range(n), "b": spark.range(1)} if n == 1 else {"a": spark.range(n)}, root)
    stray = commits.stage({"a": spark.range(9)}, root)["a"]
    assert [(r.number, r.table_name) for r in commits.history(spark, root).orderBy("number", "table_name").collect()] == [
        (n, t) for n in (1, 2, 3, 4) for t in ("a", "b")
    ]
    assert commits.tables_at(spark, root, 2)["b"] == commits.head(spark, root)[1]["b"]
    assert commits.vacuum(spark, root) == []  # all too young
    gone = commits.vacuum(spark, root, keep=2, min_age_hours=0)
    assert len(gone) == 3 and stray in gone
    assert commits.numbers(spark, root) == [3, 4]
    assert spark.read.parquet(f"{root}/{commits.tables_at(spark, root, 3)['a']}").count() == 3
    assert zones.read_table(spark, root, "a").count() == 4 and zones.read_table(spark, root, "b").count() == 1


def test_a_folder_without_a_record_is_read(spark):
    root = work_path(spark, "zone")
    spark.range(4).write.parquet(f"{root}/a")
    assert zones.read_table(spark, root, "a").count() == 4 and zones.existing(spark, root, ["a", "b"]) == ["a"]
    zones.write_table(spark.range(2), root, "a")
    assert zones.read_table(spark, root, "a").count() == 2


def star(spark, rating):
    return {
        "dim_users": spark.createDataFrame([("u", 1, 4.0)], "user_id string, user_activity_frequency long, user_avg_rating double"),
        "dim_products": spark.createDataFrame(
            [("p", "n", 4.0, 1)], "product_id string, product_name string, item_avg_rating double, item_interaction_count long"
        ),
        "fact_interactions": spark.createDataFrame([("r", "u", "p", rating)], "review_id string, user_id string, product_id string, rating double"),
    }


def test_warehouse_is_loaded_whole_or_not(spark):
    root = work_path(spark, "warehouse")
    assert warehouse.load(spark, star(spark, 4.0), root) == 1
    with pytest.raises(IntegrityError, match="rating bounds"):
        warehouse.load(spark, star(spark, 9.0), root)
    assert zones.read_table(spark, root, "fact_interactions").first().rating == 4.0
    assert commits.numbers(spark, root) == [1]


def test_dataset_without_a_contract_is_judged(spark):
    """It lacks no column; duplicates decide. An unreadable file of an earlier day stops nothing."""
    lake = work_path(spark, "lake")
    for name, df in (("extra", spark.range(3)), ("twice", spark.range(3).unionAll(spark.range(1)))):
        landing.land(df, f"{lake}/raw/{name}", "2024-01-02")
    place, fs = filesystem(spark, f"{lake}/raw/extra/ingest_date=2024-01-01/part-0.parquet")
    out = fs.create(place, False)
    out.write(bytearray(b"no parquet"))
    out.close()
    report, gate = stages.validate(spark, lake)
    assert {r.dataset: (r.schema_ok, r.quality_ok, r.promoted) for r in gate.collect()} == {
        "extra": (True, True, True), "twice": (True, False, False),
    }
    assert report.where("dataset = 'twice' AND check = 'duplicates'").first().n_bad == 1
    assert zones.existing(spark, f"{lake}/validated", ["extra", "twice"]) == ["extra"]


def test_payload_day_without_responses_replaces(spark):
    path = work_path(spark, "payloads")
    some = spark.createDataFrame([('{"a": 1}',)], "payload string")
    landing.land_payloads(some, path, "2024-01-01")
    landing.land_payloads(some, path, "2024-01-02")
    landing.land_payloads(some.limit(0), path, "2024-01-01")
    days = {r[0]: r[1] for r in spark.read.text(path).groupBy(F.col("ingest_date").cast("string")).count().collect()}
    assert days == {"2024-01-02": 1}
