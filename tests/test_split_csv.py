import csv
import random

import pytest
from pyspark.sql import functions as F

from basketry.functions.coercion import null_tokens_to_null
from basketry.sources import files, split_csv


def write(path, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator=end).writerows(rows)


def texts(rng):
    parts = ["plain", 'say "hi"', "a,b", "line\nbreak", '"', "\n", "é😀", " ", "", "x" * 40, '""', "two\n\nbreaks", "'"]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(4)))


def one_task(spark, path):
    return spark.read.options(header=True, quote='"', escape='"', multiLine=True).csv(path)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("width", [60, 100_000])
def test_rows_equal_the_one_task_reader(spark, tmp_path, width, end):
    """Ranges far smaller than records, about one record, and one range."""
    rng = random.Random(width)
    for n in range(2):
        write(tmp_path / f"part{n}.csv", [("id", "text", "more")] + [(f"{n}-{k}", texts(rng), texts(rng)) for k in range(60)], end)
    path = str(tmp_path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    expected = one_task(spark, path).collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(width))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = split_csv._lines(spark, path)
        ranges = lines.select("file", "start").distinct().count()
        df = files.read_csv(spark, path, free_text=True)
        got = df.orderBy("ingest_seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert ranges > 20 if width < 100 else ranges >= 2
    clean = null_tokens_to_null(spark.createDataFrame(expected, "id string, text string, more string")).collect()
    assert sorted(map(str, (tuple(r)[:3] for r in got))) == sorted(map(str, map(tuple, clean)))
    # ingest_seq orders each file's rows as they stand in it.
    assert [r.id for r in got] == [f"{n}-{k}" for n in range(2) for k in range(60)]


def test_missing_file_and_header_only(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_csv(spark, str(tmp_path / "none.csv"), free_text=True)
    write(tmp_path / "h.csv", [("a", "b")])
    df = files.read_csv(spark, str(tmp_path / "h.csv"), free_text=True)
    assert df.columns == ["a", "b", "ingest_seq"] and df.collect() == []


def test_one_record_over_many_ranges(spark, tmp_path):
    write(tmp_path / "l.csv", [("a", "b"), ("1", "x\n" * 800), ("2", "y")])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        rows = files.read_csv(spark, str(tmp_path / "l.csv"), free_text=True).select("a", F.length("b").alias("n")).orderBy("a").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [tuple(r) for r in rows] == [("1", 1600), ("2", 1)]
