"""Warehouse constraints as audits: each lists its violations; a load needs all of them empty."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.literals import lines, name, quoted


class IntegrityError(ValueError):
    """A table broke a declared constraint."""


def primary_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once or hold a null, with their row count ``n_rows``."""
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | F.col(k).isNull()
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.where((F.col("n_rows") > 1) | has_null)


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_null) of the declared columns that hold nulls, from one pass."""
    counted = df.agg(*(F.expr(f"count_if({name(c)} IS NULL) AS n{i}") for i, c in enumerate(columns)))
    rows = [[("column", quoted(c)), ("n_null", f"n{i}")] for i, c in enumerate(columns)]
    return counted.select(lines(rows)).where("n_null > 0")


def foreign_key(fact: DataFrame, column: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """(key, n_rows) of the fact keys without a dimension row; a null key refers to nothing.

    The fact is folded to its distinct keys before the join, so a hot key costs one row.
    """
    keys = fact.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(F.count(F.lit(1)).alias("n_rows"))
    known = dim.select(F.col(dim_key).alias("key"))
    return keys.join(known, "key", "left_anti")


def check_between(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows whose value is outside ``low..high``; a null passes, as a SQL CHECK does."""
    return df.where(~F.col(column).between(low, high))


def conform(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """The declared columns in order, each cast to its declared type."""
    return df.select(*(F.col(c).cast(t).alias(c) for c, t in types.items()))


def violations(audits: Mapping[str, DataFrame]) -> DataFrame:
    """(audit, n_violations), one row per audit."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_violations")).select(F.lit(audit).alias("audit"), "n_violations")
        for audit, df in audits.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def require_clean(audits: Mapping[str, DataFrame]) -> None:
    """Raise when an audit lists a violation. Collects one row per audit."""
    broken = violations(audits).where("n_violations > 0").collect()
    if broken:
        raise IntegrityError("; ".join(f"{r.audit}: {r.n_violations}" for r in broken))

