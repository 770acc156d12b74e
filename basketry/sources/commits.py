"""Sets of tables that change together: versions in folders, and one small record that names them.

A zone's folder holds ``_versions/<table>-<id>``, never changed once written, and
``_commits/<number>.json``. The highest complete record says which version of each table
counts; it is read before any table. Writing adds versions first and the record last, so readers see
either the whole old set or the whole new one, and a job that dies leaves folders that nothing names.
A record is moved into place under a number that must be free: of two writers the later one takes the
next number, on top of the other's record.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from basketry.sources.publish import filesystem

COMMITS, VERSIONS = "_commits", "_versions"
_RETRIES = 20


def stage(tables: Mapping[str, DataFrame], root: str) -> dict[str, str]:
    """Write each table as a new version that nothing names yet; returns table name to version folder.

    A table may be computed from the zone's current versions, which stay as they are.
    """
    staged = {}
    for name, df in tables.items():
        staged[name] = f"{VERSIONS}/{name}-{uuid.uuid4().hex[:12]}"
        df.write.parquet(f"{root}/{staged[name]}")
    return staged


def commit(spark: SparkSession, root: str, staged: Mapping[str, str], drop: tuple[str, ...] = ()) -> int:
    """Make the staged versions count, all at once, and return the record's number. Tables not named keep theirs."""
    for _ in range(_RETRIES):
        number, tables = head(spark, root)
        tables = {name: path for name, path in tables.items() if name not in drop}
        record = {"tables": {**tables, **staged}, "at": datetime.now(timezone.utc).isoformat(), "complete": True}
        if _place(spark, root, number + 1, json.dumps(record, sort_keys=True)):
            return number + 1
    raise OSError(f"no free record under {root}/{COMMITS} after {_RETRIES} tries")


def publish(spark: SparkSession, tables: Mapping[str, DataFrame], root: str) -> int:
    """Replace all given tables of the zone in one step."""
    return commit(spark, root, stage(tables, root))


def head(spark: SparkSession, root: str) -> tuple[int, dict[str, str]]:
    """The last number taken, and table to version folder by the newest complete record; (0, {}) before the first.

    Both from one listing: a record that appears later takes the number that ``commit`` tries next.
    """
    found = numbers(spark, root)
    records = (_record(spark, root, number) for number in reversed(found))
    return (found[-1] if found else 0), next((r["tables"] for r in records if r is not None), {})


def numbers(spark: SparkSession, root: str) -> list[int]:
    """The records there are, ascending; from a listing."""
    place, fs = filesystem(spark, f"{root}/{COMMITS}")
    if not fs.exists(place):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(place))
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())


def tables_at(spark: SparkSession, root: str, number: int) -> dict[str, str]:
    """The set of an earlier record."""
    record = _record(spark, root, number)
    if record is None:
        raise FileNotFoundError(f"no record {number} under {root}/{COMMITS}")
    return record["tables"]


def history(spark: SparkSession, root: str) -> DataFrame:
    """(number, committed_at, table_name, version) of every record kept."""
    rows = [
        (number, record["at"], name, path)
        for number in numbers(spark, root)
        if (record := _record(spark, root, number))
        for name, path in sorted(record["tables"].items())
    ]
    return spark.createDataFrame(rows, "number long, committed_at string, table_name string, version string")


def vacuum(spark: SparkSession, root: str, keep: int = 2, min_age_hours: float = 24.0) -> list[str]:
    """Delete versions that none of the last ``keep`` records names, and older records; returns the versions deleted.

    A folder younger than ``min_age_hours`` may belong to a job that has not committed yet and stays.
    """
    found = numbers(spark, root)
    kept = [record for n in found[-keep:] if (record := _record(spark, root, n))]
    named = {"/".join(path.split("/")[:2]) for record in kept for path in record["tables"].values()}  # a table may be a part of a version
    place, fs = filesystem(spark, f"{root}/{VERSIONS}")
    if not kept or not fs.exists(place):
        return []
    before = (time.time() - min_age_hours * 3600) * 1000
    gone = []
    for status in fs.listStatus(place):
        path = f"{VERSIONS}/{status.getPath().getName()}"
        if path not in named and status.getModificationTime() <= before:
            fs.delete(status.getPath(), True)
            gone.append(path)
    for number in found[:-keep]:
        fs.delete(filesystem(spark, _path(root, number))[0], False)
    return sorted(gone)


def _path(root: str, number: int) -> str:
    return f"{root}/{COMMITS}/{number:012d}.json"


def _record(spark: SparkSession, root: str, number: int) -> dict | None:
    """The record, or None where it is missing or cut short."""
    place, fs = filesystem(spark, _path(root, number))
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        record = json.loads(text)
    except ValueError:
        return None
    return record if record.get("complete") else None


def _place(spark: SparkSession, root: str, number: int, text: str) -> bool:
    """Write the record beside and move it to its number; False where that is taken."""
    target = _path(root, number)
    beside, fs = filesystem(spark, f"{root}/{COMMITS}/_new-{uuid.uuid4().hex[:12]}")
    out = fs.create(beside, False)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(beside.toUri(), spark._jsc.hadoopConfiguration())
    nothing = spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
    try:
        context.rename(beside, filesystem(spark, target)[0], nothing)  # fails where the target exists
    except Py4JJavaError as error:
        fs.delete(beside, False)
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True
