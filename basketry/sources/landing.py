"""Dated landing zone: partition writes, latest-partition reads, the ingest loop."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from basketry.sources.files import payload_item_count, read_csv
from basketry.sources.publish import folders, replace_folder, replace_parquet
from basketry.specs import DatasetSpec

DATE = "ingest_date"


def utc_date() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d")


def land(df: DataFrame, path: str, date: str | Column | None = None) -> None:
    """Write ``df`` under its date; a date written before is replaced, others stay.

    A fixed date adds no shuffle, and its folder is replaced also by a landing without
    rows. A date column is rebalanced first, so that each date gets few files and a
    heavy date several writers.
    """
    if isinstance(date, Column):
        dated = df.withColumn(DATE, date).hint("rebalance", F.col(DATE))
        dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DATE).parquet(path)
    else:
        replace_parquet(df, f"{path}/{DATE}={date or utc_date()}")


def landed(spark: SparkSession, root: str) -> list[str]:
    """Names of the datasets under ``root`` that have a landing, ascending; from listings, no file is opened."""
    names = [n for n in folders(spark, root, "") if n[0] not in "_."]
    return [n for n in names if folders(spark, f"{root}/{n}", f"{DATE}=")]


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the greatest date as they were landed: with its own columns, without the date.

    The date comes from the folder names; no file of another date is opened.
    """
    dates = folders(spark, path, f"{DATE}=")
    if not dates:
        raise FileNotFoundError(f"nothing landed under {path}")
    return spark.read.parquet(f"{path}/{dates[-1]}")


def land_payloads(payloads: DataFrame, path: str, date: str | None = None) -> None:
    """Keep fetched JSON responses as they came, under their date; also a day without any replaces what it had."""
    texts = payloads.select("payload")
    replace_folder(payloads.sparkSession, lambda new: texts.write.text(new), f"{path}/{DATE}={date or utc_date()}")


def land_parsed(payloads: DataFrame, path: str, date: str | None = None) -> None:
    """Land JSON responses in two lanes: parsed as a VARIANT, or as they came where they do not parse.

    One column of the two is null in each row; the other columns of ``payloads`` stay.
    """
    parsed = payloads.withColumn("value", F.try_parse_json("payload"))
    unparsed = F.when(F.col("value").isNull(), F.col("payload")).alias("unparsed")
    land(parsed.select(*(c for c in payloads.columns if c != "payload"), "value", unparsed), path, date or utc_date())


def ingest(
    spark: SparkSession, sources: Iterable[tuple[str, DataFrame | str]], raw_root: str, date: str,
    specs: Mapping[str, DatasetSpec] | None = None,
) -> DataFrame:
    """Land every source; one that fails is reported and the rest go on.

    A source is a DataFrame or a CSV path. Rows are counted while they are
    written. Returns (dataset, ok, n_rows, error).
    """
    rows = []
    for name, source in sources:
        try:
            if isinstance(source, str):
                spec = (specs or {}).get(name)
                source = read_csv(spark, source, free_text=bool(spec and spec.free_text))
            seen = Observation()
            land(source.observe(seen, F.count(F.lit(1)).alias("n")), f"{raw_root}/{name}", date)
            rows.append((name, True, int(seen.get["n"]), None))
        except Exception as error:  # whatever stops one source must not stop the others
            rows.append((name, False, 0, str(error).split("\n")[0]))
    return spark.createDataFrame(rows, "dataset string, ok boolean, n_rows long, error string")


def ingest_payloads(payloads: DataFrame, path: str, date: str) -> int:
    """Land JSON responses and return how many entries they hold."""
    seen = Observation()
    counted = payloads.observe(seen, F.sum(payload_item_count(F.col("payload"))).alias("n"))
    land_payloads(counted, path, date)
    return int(seen.get["n"] or 0)
