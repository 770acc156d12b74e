"""Folders that are replaced as a whole: written beside, then switched in."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def filesystem(spark: SparkSession, path: str):
    """The path as Hadoop knows it, and the file system it is on."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names of the folders under ``path`` that begin with ``prefix``, ascending; from a listing, without reading files."""
    place, fs = filesystem(spark, path)
    return sorted(n for s in fs.listStatus(place) if s.isDirectory() and (n := s.getPath().getName()).startswith(prefix))


def replace_parquet(df: DataFrame, path: str) -> None:
    """Write ``df`` as ``path``. A job that fails leaves the older folder as it was; ``df`` may read that folder."""
    replace_folder(df.sparkSession, lambda new: df.write.parquet(new), path)


def replace_folder(spark: SparkSession, write: Callable[[str], None], path: str) -> None:
    """``write`` a folder beside ``path`` and switch it in. Tables that have to change together, or never to be
    absent, are published by ``commits`` instead: between the two renames here the folder is missing."""
    parent, _, name = path.rstrip("/").rpartition("/")
    mark = uuid.uuid4().hex[:12]
    new, old = f"{parent}/_new-{name}-{mark}", f"{parent}/_old-{name}-{mark}"
    write(new)
    target, fs = filesystem(spark, path)
    backup, fresh = filesystem(spark, old)[0], filesystem(spark, new)[0]
    had = fs.exists(target)
    if had and not fs.rename(target, backup):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(fresh, target):
        if had:
            fs.rename(backup, target)
        raise OSError(f"cannot put {new} in place of {path}")
    if had:
        fs.delete(backup, True)
