"""Validated, processed and warehouse zones: Parquet tables that are published as sets (``commits``)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.sources import commits
from basketry.sources.publish import filesystem


def write_tables(tables: Mapping[str, DataFrame], root: str) -> None:
    """Replace all of the tables in one step; a job that fails, at whichever table, leaves the older set."""
    if tables:
        commits.publish(next(iter(tables.values())).sparkSession, tables, root)


def write_table(df: DataFrame, root: str, name: str) -> None:
    """Replace the table; a job that fails leaves the older one."""
    write_tables({name: df}, root)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The table, or None when the zone lacks it."""
    return _read(spark, root, name, commits.head(spark, root)[1])


def _read(spark: SparkSession, root: str, name: str, named: Mapping[str, str]) -> DataFrame | None:
    if name in named:
        return spark.read.parquet(f"{root}/{named[name]}")
    try:
        return spark.read.parquet(f"{root}/{name}")  # a folder that was put there without a record
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def require_tables(spark: SparkSession, root: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """All named tables, of one set; a FileNotFoundError lists the ones missing."""
    named = commits.head(spark, root)[1]
    found = {name: _read(spark, root, name, named) for name in names}
    missing = [f"{root}/{name}" for name, df in found.items() if df is None]
    if missing:
        raise FileNotFoundError(f"inputs missing: {', '.join(missing)}")
    return found


def promote(tables: Mapping[str, DataFrame], verdict: DataFrame, root: str) -> list[str]:
    """Write the tables whose verdict is positive, as one set; a failed one keeps its older copy.

    Collects one verdict row per dataset.
    """
    passed = [r.dataset for r in verdict.where("promoted").select("dataset").collect()]
    done = [name for name in tables if name in passed]
    write_tables({name: tables[name] for name in done}, root)
    return done


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) of every table."""
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


def existing(spark: SparkSession, root: str, names: Iterable[str]) -> list[str]:
    """The named tables the zone has; no file is opened but the record."""
    named = commits.head(spark, root)[1]

    def there(name: str) -> bool:
        place, fs = filesystem(spark, f"{root}/{name}")
        return fs.exists(place)

    return [name for name in names if name in named or there(name)]
