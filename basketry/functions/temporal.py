"""Date parsing and date parts with the contract's null rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
KNOWN_FORMATS = (
    DATE_FORMAT, TIMESTAMP_FORMAT, "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy/MM/dd", "MM/dd/yyyy", "MM/dd/yyyy HH:mm:ss", "dd/MM/yyyy", "dd-MM-yyyy",
)


def infer_format(
    df: DataFrame, column: str, order: Sequence[str | Column], formats: Sequence[str] = KNOWN_FORMATS
) -> str | None:
    """The format, of those given, of the column's first value, which then holds for the whole column.

    None when the first value fits no format, or there is no value. Reads one value.
    """
    if not isinstance(df.schema[column].dataType, T.StringType):
        return None
    first = df.where(F.col(column).isNotNull()).orderBy(*order).select(F.col(column).alias("v")).limit(1)
    fits = [F.when(F.try_to_timestamp("v", F.lit(f)).isNotNull(), F.lit(f)) for f in formats]
    row = first.select(F.coalesce(*fits).alias("f")).first()
    return row.f if row else None


def parse_datetime(df: DataFrame, column: str, fmt: str | None, formats: Sequence[str] = KNOWN_FORMATS) -> Column:
    """``column`` as a timestamp; text in any other format becomes null (``date_losses`` counts it).

    Without a format each value is read in the first of ``formats`` it fits.
    """
    if isinstance(df.schema[column].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.col(column)
    tried = formats if fmt is None else (fmt,)
    return F.coalesce(*(F.try_to_timestamp(F.col(column), F.lit(f)) for f in tried))


def date_losses(
    df: DataFrame, columns: Sequence[str], order: Sequence[str | Column], formats: Sequence[str] = KNOWN_FORMATS
) -> DataFrame:
    """(column, date_format, n_values, n_lost): what parsing each column by its first value's format turns into null.

    One pass for all columns, after one value of each was read.
    """
    chosen = {c: infer_format(df, c, order, formats) for c in columns}
    counts = []
    for i, c in enumerate(columns):
        parsed = parse_datetime(df, c, chosen[c], formats)
        counts += [F.count(c).alias(f"n{i}"), F.count_if(F.col(c).isNotNull() & parsed.isNull()).alias(f"l{i}")]
    rows = F.array(*(
        F.struct(
            F.lit(c).alias("column"), F.lit(chosen[c]).cast("string").alias("date_format"),
            F.col(f"n{i}").alias("n_values"), F.col(f"l{i}").alias("n_lost"),
        )
        for i, c in enumerate(columns)
    ))
    return df.agg(*counts).select(F.inline(rows))


def year_or_zero(ts: Column) -> Column:
    return F.coalesce(F.year(ts), F.lit(0)).cast("long")


def month_or_zero(ts: Column) -> Column:
    return F.coalesce(F.month(ts), F.lit(0)).cast("long")


def hour_or_minus_one(ts: Column) -> Column:
    return F.coalesce(F.hour(ts), F.lit(-1)).cast("long")
