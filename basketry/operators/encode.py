"""Label codes, min-max scaling, log scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.operators.impute import known, present

# A dictionary is broadcast only when its estimated size is under this.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def label_encode(df: DataFrame, columns: Mapping[str, str], max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Add for each column its code: 0-based rank among the sorted distinct values, null and NaN = -1.

    ``columns`` maps a column to its code column. One pass sizes all
    dictionaries; small ones are broadcast, large ones are sorted and joined by
    shuffle, where adaptive execution splits hot values.
    """
    sizes = dictionary_sizes(df, list(columns))
    out = df
    for column, code in columns.items():
        small = sizes[column] <= max_bytes
        codes = small_dictionary(df, column) if small else large_dictionary(df, column)
        codes = codes.toDF("_value", code)
        # NaN is not among the values, so it finds no code.
        joined = out.join(F.broadcast(codes) if small else codes, out[column] == codes["_value"], "left")
        out = joined.drop("_value").withColumn(code, F.coalesce(F.col(code), F.lit(-1)).cast("int"))
    return out.select(*df.columns, *columns.values())


def dictionary_sizes(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Estimated bytes of each column's distinct values, from one aggregate row."""
    aggregates: list[Column] = []
    for c in columns:
        text = F.col(c).cast("string")
        aggregates += [F.approx_count_distinct(known(df, c)), F.max(F.octet_length(text))]
    row = df.agg(*(a.alias(f"s{i}") for i, a in enumerate(aggregates))).first()
    return {c: int(row[2 * i] * ((row[2 * i + 1] or 0) + 48)) for i, c in enumerate(columns)}


def small_dictionary(df: DataFrame, column: str) -> DataFrame:
    """(value, code) of a column whose dictionary fits one row.

    Distinct values are folded first: one task gets each value once, not a set from every map task.
    """
    distinct = df.select(known(df, column).alias("v")).where("v IS NOT NULL").distinct()
    values = distinct.agg(F.array_sort(F.collect_list("v")).alias("v"))
    return values.select(F.posexplode("v").alias("code", "value")).select("value", "code")


def large_dictionary(df: DataFrame, column: str) -> DataFrame:
    """(value, code) of any column: a distributed sort, then row offsets per partition.

    The sorted values are checkpointed, so that the partition ids the offsets
    rest on cannot change when a task is run again.
    """
    from basketry.session import shared_dir

    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    ordered = (
        df.select(known(df, column).alias("value")).where("value IS NOT NULL").distinct().orderBy("value")
        .withColumn("id", F.monotonically_increasing_id())
        .checkpoint()
    )
    part = F.shiftright("id", 33)
    # One row per partition, so the global window is bounded by the partition count.
    sizes = ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    placed = ordered.withColumn("part", part).join(F.broadcast(offsets), "part")
    return placed.select("value", (F.col("before") + F.col("id") - F.shiftleft("part", 33)).alias("code"))


def minmax_scale(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Scale each column to 0..1 over its range; a constant or empty column gives 0.0. NaN counts as null.

    All bounds come from one aggregate row, used as a scalar subquery.
    """
    bounds = df.agg(
        F.struct(
            *(F.min(present(c)).alias(f"lo_{c}") for c in columns), *(F.max(present(c)).alias(f"hi_{c}") for c in columns)
        ).alias("b")
    ).scalar()
    return df.withColumns(
        {out: scaled(present(c), bounds[f"lo_{c}"], bounds[f"hi_{c}"]) for c, out in columns.items()}
    )


def scaled(x: Column, low: Column, high: Column) -> Column:
    return F.when(high > low, (x - low) / (high - low)).otherwise(F.lit(0.0))


def clip_at_zero(x: Column) -> Column:
    """Negative to 0; null stays null."""
    return F.when(x < 0, F.lit(0.0)).otherwise(x)


def log_scale(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """ln(1 + x) with negatives taken as 0; null and NaN give null."""
    return df.withColumns({out: F.log1p(clip_at_zero(present(c))) for c, out in columns.items()})
