import pytest
from pyspark.sql import functions as F

from basketry import session
from basketry.operators import quality
from basketry.session import spread, work_path
from basketry.sources import files, landing, zones


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_quotes_breaks_tokens_and_order(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'id,txt,n\n3,"a, ""b""\nnext",NA\n1,,5\n2,None,1e3\n')
    df = files.read_csv(spark, path, free_text=True)
    assert rows(df.orderBy(files.SEQ).select("id", "txt", "n")) == [
        ("3", 'a, "b"\nnext', None), ("1", None, "5"), ("2", None, "1e3"),
    ]
    assert files.read_csv(spark, path, sequence=False).columns == ["id", "txt", "n"]


def test_csv_order_over_many_splits(spark, tmp_path):
    path = write(tmp_path / "long.csv", "id\n" + "".join(f"{(i * 7919) % 5000}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = files.read_csv(spark, path)
        assert df.rdd.getNumPartitions() > 4
        assert [int(r.id) for r in df.orderBy(files.SEQ).collect()] == [(i * 7919) % 5000 for i in range(5000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_missing_csv(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_csv(spark, str(tmp_path / "no.csv"))


def test_payload_items(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i, text in enumerate(['{"products": [{"id": 1}, {"id": 2}],\n "total": 2}', "[1, 2, 3]", '{"other": []}', "broken"]):
        write(tmp_path / "in" / f"{i}.json", text)
    payloads = files.read_payloads(spark, str(tmp_path / "in"))
    assert payloads.count() == 4
    target = work_path(spark, "payloads")
    assert landing.ingest_payloads(payloads, target, "2024-01-01") == 5


def test_landing_replaces_one_day(spark):
    path = work_path(spark, "landing")
    landing.land(spark.range(5), path, "2024-01-01")
    landing.land(spark.range(3), path, "2024-01-02")
    landing.land(spark.range(4), path, "2024-01-01")
    days = spark.read.parquet(path).groupBy(F.col("ingest_date").cast("string").alias("d")).count()
    assert rows(days, "d") == [("2024-01-01", 4), ("2024-01-02", 3)]
    assert landing.read_latest(spark, path).count() == 3


def test_latest_reads_one_partition(spark):
    path = work_path(spark, "landing")
    for day in ("2024-01-09", "2024-01-10"):
        landing.land(spark.range(3), path, day)
    df = landing.read_latest(spark, path)
    assert df.count() == 3
    assert df.inputFiles() and all("/ingest_date=2024-01-10/" in f for f in df.inputFiles())


def test_ingest_goes_on_after_a_failure(spark, tmp_path):
    good = write(tmp_path / "good.csv", "a,b\n1,2\n3,4\n")
    metrics = landing.ingest(spark, [("bad", str(tmp_path / "no.csv")), ("good", good)], work_path(spark, "raw"), "2024-01-01")
    assert [tuple(r)[:3] for r in metrics.orderBy("dataset").collect()] == [("bad", False, 0), ("good", True, 2)]


def test_gate_keeps_the_old_copy(spark):
    root = work_path(spark, "validated")
    zones.write_table(spark.range(2), root, "a")
    verdict = spark.createDataFrame([("a", False), ("b", True)], "dataset string, promoted boolean")
    assert zones.promote({"a": spark.range(9), "b": spark.range(4)}, verdict, root) == ["b"]
    assert zones.read_table(spark, root, "a").count() == 2 and zones.read_table(spark, root, "b").count() == 4


def test_required_tables(spark):
    root = work_path(spark, "zone")
    zones.write_table(spark.range(1), root, "a")
    with pytest.raises(FileNotFoundError, match="/b, .*/c"):
        zones.require_tables(spark, root, ["a", "b", "c"])


def test_schema_check_needs_no_data(spark):
    from basketry.specs import DATASETS

    df = spark.createDataFrame([], "user_id string, age string, extra string")
    found = rows(quality.schema_check([("users", df, DATASETS["users"]), ("other", df, None)], spark), "dataset")
    assert found[0] == ("other", 0, "", True)
    assert found[1][1] == 7 and not found[1][3]


def test_shared_dir_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        assert session.shared_dir(spark) == named.rstrip("/")
    assert session.shared_dir(spark) == session.shared_dir(spark)


def test_spread_leaves_split_tables_alone(spark):
    assert spread(spark.range(0, 10, 1, 1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 100, 1, 32)
    assert spread(many) is many
