"""Constant and exact-median imputation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from basketry.functions.literals import name
from basketry.operators.selection import medians

# The exact percentile keeps one counter per distinct value in its buffer. Up to this many
# distinct values that buffer is small; beyond it the median is found by bracketing.
MAX_PERCENTILE_VALUES = 1_000_000


def fill_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.na.fill(dict(values))


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value in every column. Plain null tests, which reach the Parquet scan."""
    return df.where(" AND ".join(f"{name(c)} IS NOT NULL" for c in columns))


def distinct_estimates(df: DataFrame, columns: Sequence[str | Column]) -> list[int]:
    """Approximate distinct counts of all columns in one pass."""
    row = df.agg(*(F.approx_count_distinct(c).alias(f"d{i}") for i, c in enumerate(columns))).first()
    return [int(v) for v in row]


def present(column: str) -> Column:
    """The column with NaN as null."""
    return F.when(~F.isnan(F.col(column).cast("double")), F.col(column))


def known(df: DataFrame, column: str) -> Column:
    """The column with NaN as null where its type has NaN; text stays as it is."""
    return present(column) if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)) else F.col(column)


def median_column(df: DataFrame, column: str, n_distinct: int | None = None) -> Column:
    """The exact median of ``column`` (null when there is no value; NaN is none), as a column.

    Both ways give the same number. With few distinct values it is a scalar subquery; with many it is searched
    for first and comes back as a literal.
    """
    if n_distinct is None:
        (n_distinct,) = distinct_estimates(df, [column])
    if n_distinct <= MAX_PERCENTILE_VALUES:
        # Values are counted first, so that one task merges distinct values, not a buffer of every map task.
        counts = df.select(present(column).alias("x")).where("x IS NOT NULL").groupBy("x").agg(F.count("*").alias("n"))
        return counts.agg(F.percentile("x", 0.5, F.col("n")).alias("m")).scalar()
    return F.lit(bracketed_median(df, column)).cast("double")


def median_impute(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls and NaN replaced by the column's exact median; a column without values becomes null.

    All medians are searched for together (``selection``), whatever the number of columns.
    """
    found = medians(df, columns)
    return df.withColumns({c: F.coalesce(present(c), F.lit(found[c]).cast("double")) for c in columns})


def bracketed_median(
    df: DataFrame, column: str, max_values: int = MAX_PERCENTILE_VALUES, accuracy: int = 10_000
) -> float | None:
    """Exact median with bounded state, for any number of distinct values.

    A quantile sketch brackets the middle ranks; one counting pass proves where
    they fall; the open bracket is searched again until it is small. Every pass
    aggregates to one row, and a heavy value ends the search when it is hit.
    """
    values = df.select(F.col(column).cast("double").alias("x"))
    values = values.where(F.col("x").isNotNull() & ~F.isnan("x"))
    values.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = values.count()
        if n == 0:
            return None
        ranks = sorted({(n - 1) // 2, n // 2})
        found = [_value_at_rank(values, r, n, max_values, accuracy) for r in ranks]
        return sum(found) / len(found)
    finally:
        values.unpersist()


def _value_at_rank(values: DataFrame, rank: int, n: int, max_values: int, accuracy: int) -> float:
    inside, size, offset = values, n, 0  # offset: values below the current bracket
    while size > max_values:
        middle, slack = (rank - offset) / size, 2.0 / accuracy
        lo, hi = inside.agg(
            F.percentile_approx("x", [max(middle - slack, 0.0), min(middle + slack, 1.0)], accuracy)
        ).first()[0]
        x = F.col("x")
        below, at_lo, between, at_hi = inside.agg(
            F.count_if(x < lo), F.count_if(x == lo), F.count_if((x > lo) & (x < hi)), F.count_if((x == hi) & (x > lo))
        ).first()
        local = rank - offset
        if local < below:
            inside, size = inside.where(x < lo), below
        elif local < below + at_lo:
            return lo
        elif local < below + at_lo + between:
            inside, size, offset = inside.where((x > lo) & (x < hi)), between, offset + below + at_lo
        elif local < below + at_lo + between + at_hi:
            return hi
        else:
            passed = below + at_lo + between + at_hi
            inside, size, offset = inside.where(x > hi), size - passed, offset + passed
    # At most max_values doubles are left.
    return inside.agg(F.element_at(F.array_sort(F.collect_list("x")), rank - offset + 1)).first()[0]
