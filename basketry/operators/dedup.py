"""Keep-first deduplication and duplicate counting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.literals import name


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first by ``order``; null keys count as equal.

    The rank filter reaches the map side as a group limit, so a key that holds a
    third of the table still ships one row per map task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def row_digest(df: DataFrame) -> Column:
    """SHA-256 of a row's values; equal rows have equal digests, nulls and texts kept apart."""
    values = []
    for f in df.schema.fields:
        c = name(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = f"{c} + 0.0D"  # -0.0 equals 0.0
        if isinstance(f.dataType, T.BinaryType):
            text = f"hex({c})"
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            text = c  # JSON keeps the elements apart
        else:
            text = f"CAST({c} AS STRING)"
        values.append(f"{text} AS {name(f.name)}")
    return F.expr(f"unhex(sha2(to_json(struct({', '.join(values)})), 256))")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Row count and extra copies of full rows, nulls equal.

    Copies fold on the map side; a few fixed-width columns are grouped as they
    are, anything wider by a 32-byte digest, so long texts are never shuffled.
    """
    narrow = len(df.columns) <= 4 and all(isinstance(f.dataType, T.NumericType) for f in df.schema.fields)
    copies = df.groupBy(*df.columns) if narrow else df.groupBy(row_digest(df).alias("_digest"))
    return copies.agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
    )
