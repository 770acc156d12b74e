"""Hash trees over the keys of a table: two states are compared by hashes, and only where they differ by rows.

A row's key says its bucket, the buckets are the leaves of a tree, and a node's hash is the sum of the
row hashes below it. Two trees are compared node by node; only buckets whose hashes differ are read
again, and their rows are folded by key, so equal parts of the tables are not shuffled and nothing
is joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAN_BITS = 4  # a node has 16 children
DEPTH = 3  # levels below the root: 4096 buckets


def value_hash(*columns: str) -> Column:
    """A 64-bit hash of the columns' values; xxhash64 passes over nulls, so each goes in with its null flag."""
    return F.xxhash64(*(x for c in columns for x in (F.col(c).isNull(), F.col(c)))).cast("decimal(38,0)")


def bucket(key: str, depth: int = DEPTH) -> Column:
    return F.pmod(F.xxhash64(F.col(key).isNull(), F.col(key)), F.lit(1 << FAN_BITS * depth)).cast("int")


def hash_tree(df: DataFrame, key: str, columns: Sequence[str] | None = None, depth: int = DEPTH) -> DataFrame:
    """(level, node, n_rows, content) of all nodes with rows; level 0 is the root, ``depth`` the buckets.

    One aggregate over the rows, folded on the map side; the levels above sum at most 16 ** depth leaves.
    """
    leaves = df.groupBy(bucket(key, depth).alias("leaf")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(value_hash(*(columns or df.columns))).alias("content")
    )
    levels = F.array(*(
        F.struct(F.lit(level).alias("level"), F.floor(F.col("leaf") / (1 << FAN_BITS * (depth - level))).cast("int").alias("node"))
        for level in range(depth + 1)
    ))
    paths = leaves.select(F.explode(levels).alias("at"), "n_rows", "content")
    return paths.groupBy("at.level", "at.node").agg(F.sum("n_rows").alias("n_rows"), F.sum("content").alias("content"))


def differing_nodes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(level, node) in which two trees differ; no root, no difference. The trees are stacked, not joined."""
    signed = before.withColumn("side", F.lit(-1)).unionByName(after.withColumn("side", F.lit(1)))
    sums = signed.groupBy("level", "node").agg(
        F.sum(F.col("side") * F.col("n_rows")).alias("rows"), F.sum(F.col("side") * F.col("content")).alias("content")
    )
    return sums.where("rows != 0 OR content != 0").select("level", "node")


def changed_keys(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, kind, changed): keys whose rows differ in ``columns``; kind is added, removed or changed.

    ``changed`` names the columns that differ, comma-joined, of a key that is on both sides. Types of
    ``after`` are brought to those of ``before``. At most 16 ** DEPTH bucket numbers reach the driver.
    """
    same = after.select(*(F.col(c).cast(before.schema[c].dataType).alias(c) for c in (key, *columns)))
    sides = {-1: before.select(key, *columns), 1: same}
    nodes = differing_nodes(*(hash_tree(df, key, columns) for df in sides.values()))
    leaves = [r.node for r in nodes.where(F.col("level") == DEPTH).select("node").collect()]
    stacked = None
    for side, df in sides.items():
        rows = df.where(bucket(key).isin(leaves)).select(
            F.col(key).alias("key"), F.lit(side).alias("side"), *(value_hash(c).alias(f"h{i}") for i, c in enumerate(columns)),
            value_hash(*columns).alias("whole"),
        )
        stacked = rows if stacked is None else stacked.unionByName(rows)
    folded = stacked.groupBy("key").agg(
        F.count_if(F.col("side") < 0).alias("n_before"), F.count_if(F.col("side") > 0).alias("n_after"),
        F.sum(F.col("side") * F.col("whole")).alias("whole"),
        *(F.sum(F.col("side") * F.col(f"h{i}")).alias(f"h{i}") for i in range(len(columns))),
    )
    kind = F.when(F.col("n_before") == 0, "added").when(F.col("n_after") == 0, "removed").otherwise("changed")
    names = F.concat_ws(",", *(F.when(F.col(f"h{i}") != 0, F.lit(c)) for i, c in enumerate(columns)))
    differ = folded.where((F.col("whole") != 0) | (F.col("n_before") != F.col("n_after")))
    return differ.select(F.col("key").alias(key), kind.alias("kind"), F.when(kind == "changed", names).otherwise("").alias("changed"))
