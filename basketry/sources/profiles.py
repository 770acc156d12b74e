"""Profiles of a landing zone from stored states, one for each date, that merge.

A state holds for every column the row and null counts, the least and greatest value, and two
sketches: of distinct values (HyperLogLog) and of quantiles (KLL). All of them add up over dates, so a
profile of all dates reads the files of dates that are new or were landed again, and the states of the
others. Counts and bounds are exact; distinct counts and quantiles come with the error of their
sketch, and the exact way (``operators.profile``) stays for those who need it.
"""

from __future__ import annotations

from hashlib import blake2b
from math import sqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.operators.impute import known
from basketry.sources import commits
from basketry.sources.landing import DATE
from basketry.sources.publish import filesystem, folders

HLL_BITS = 14
#: Three standard errors of the distinct count, relative.
DISTINCT_ERROR = 3 * 1.04 / sqrt(1 << HLL_BITS)
KLL_SIZE = 400
#: Error of a quantile's rank as a share of the values, as the sketch's authors give it for this size (99 %).
RANK_ERROR = 0.007
QUANTILES = (0.25, 0.5, 0.75)

_STATE = (
    "column string, n_rows long, n_null long, low double, high double, distinct_values binary, quantiles binary"
)


def _numeric(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def column_states(df: DataFrame) -> DataFrame:
    """One row for each column (``_STATE``), from one pass. NaN counts as null; ``low``, ``high`` and quantiles are for numbers."""
    aggregates: list[Column] = [F.count(F.lit(1)).alias("n")]
    entries = []
    for i, field in enumerate(df.schema):
        x = known(df, field.name)
        text = x.cast("string") if not isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)) else F.to_json(x)
        aggregates += [F.count(x).alias(f"c{i}"), F.hll_sketch_agg(text, F.lit(HLL_BITS)).alias(f"d{i}")]
        low = high = F.lit(None).cast("double")
        quantiles = F.lit(None).cast("binary")
        if _numeric(field.dataType):
            number = x.cast("double")
            aggregates += [F.min(number).alias(f"lo{i}"), F.max(number).alias(f"hi{i}")]
            aggregates.append(F.kll_sketch_agg_double(number, F.lit(KLL_SIZE)).alias(f"q{i}"))
            low, high, quantiles = F.col(f"lo{i}"), F.col(f"hi{i}"), F.col(f"q{i}")
        entries.append(F.struct(
            F.lit(field.name).alias("column"), F.col("n").alias("n_rows"), (F.col("n") - F.col(f"c{i}")).alias("n_null"),
            low.alias("low"), high.alias("high"), F.col(f"d{i}").alias("distinct_values"), quantiles.alias("quantiles"),
        ))
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))


def refresh(spark: SparkSession, landing: str, states: str) -> list[str]:
    """Bring the states up to the landing zone and return the dates whose files were read.

    A date counts as landed again when its files' names, sizes or times differ. All changes are one
    commit; dates that are gone lose their state.
    """
    stored = commits.head(spark, states)[1]
    now = {f"{d.removeprefix(f'{DATE}=')}/{_mark(spark, f'{landing}/{d}')}": d for d in folders(spark, landing, f"{DATE}=")}
    staged = {}
    for name in sorted(set(now) - set(stored)):
        df = spark.read.parquet(f"{landing}/{now[name]}")
        staged |= commits.stage({name: column_states(df).coalesce(1)}, states)
    gone = tuple(set(stored) - set(now))
    if staged or gone:
        commits.commit(spark, states, staged, drop=gone)
    return [name.split("/")[0] for name in staged]


def _mark(spark: SparkSession, folder: str) -> str:
    place, fs = filesystem(spark, folder)
    files = sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(place) if s.isFile())
    return blake2b(repr(files).encode(), digest_size=8).hexdigest()


def profile(spark: SparkSession, states: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """One row for each column over the dates from ``first`` to ``last``: (column, n_dates, n_rows, n_null, low, high,
    n_distinct, quantiles), from the states alone.

    ``n_distinct`` is within ``DISTINCT_ERROR`` of the exact number, a quantile's rank within ``RANK_ERROR``.
    A column that a date lacks counts as null there.
    """
    dated = {name.split("/")[0]: path for name, path in commits.head(spark, states)[1].items()}
    chosen = [path for d, path in sorted(dated.items()) if (first is None or d >= first) and (last is None or d <= last)]
    if not chosen:
        return spark.createDataFrame(
            [], "column string, n_dates long, n_rows long, n_null long, low double, high double, n_distinct long, quantiles array<double>"
        )
    rows = spark.read.schema(_STATE).parquet(*(f"{states}/{p}" for p in chosen)).withColumn("file", F.input_file_name())
    per_file = rows.groupBy("file").agg(F.max("n_rows").alias("n"))
    total = per_file.agg(F.sum("n")).scalar()
    merged = rows.groupBy("column").agg(
        F.count(F.lit(1)).alias("n_dates"), total.alias("n_rows"), (total - F.sum(F.col("n_rows") - F.col("n_null"))).alias("n_null"),
        F.min("low").alias("low"), F.max("high").alias("high"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_values")).alias("n_distinct"),
        F.kll_merge_agg_double("quantiles").alias("q"), F.count("low").alias("numbers"),
    )
    shares = F.array(*(F.lit(s) for s in QUANTILES))
    quantiles = F.when(F.col("numbers") > 0, F.kll_sketch_get_quantile_double("q", shares))
    return merged.select("column", "n_dates", "n_rows", "n_null", "low", "high", "n_distinct", quantiles.alias("quantiles"))


def sparsity(profiled: DataFrame, user: str, item: str) -> DataFrame:
    """One row (n_rows, n_users, n_items, sparsity) from a profile, within the error of its distinct counts."""
    counted = profiled.agg(
        F.max("n_rows").alias("n_rows"),
        F.max(F.when(F.col("column") == user, F.col("n_distinct"))).alias("n_users"),
        F.max(F.when(F.col("column") == item, F.col("n_distinct"))).alias("n_items"),
    )
    cells = F.nullif(F.col("n_users").cast("double") * F.col("n_items"), F.lit(0.0))
    return counted.withColumn("sparsity", 1 - F.col("n_rows") / cells)
