"""Sharding by histogram sort: near-equal bytes per shard, found by exact counts below candidate boundaries.

Documents are ordered by (hash of the text, doc_id), so equal texts are neighbours
and sizes are spread evenly whatever the order of ids. Boundaries are refined in
rounds: every round counts, in one aggregate over the narrow key table, the exact
bytes and rows between all probes; a boundary is done when it meets the tolerance or its
interval holds one row or key. One more count moves each boundary to the nearer end of the
group of equal texts it lies in, where that is within ``GROUP_SLACK`` of a shard's share from its place: groups of up to
twice that stay whole, larger ones may be cut. The rows are exchanged once, when the boundaries stand.

The driver holds probes and their counts only, bounded by shards x probes.

Null text has no bytes (16 are counted for the row) and the hash of empty text.
A null doc_id comes first among equal texts. Rows with equal text and doc_id are
never parted; an empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import fresh, unsigned
from basketry.session import materialize

ROW_BYTES = 16
PROBES = 16
#: Of a shard's share, how far a boundary may lie from its place.
TOLERANCE = 0.001
#: Of a shard's share, how far a boundary may be moved to keep equal texts together.
GROUP_SLACK = 0.05
_HALF = 1 << 63
_TOP = (1 << 128) - 1


def _split(key: int) -> tuple[int, int]:
    """A 128-bit key as the two signed integers it is made of."""
    return (key >> 64) - _HALF, (key & ((1 << 64) - 1)) - _HALF


def _bucket(probes: list[int]):
    """Counts the probes at or below each (hash, id) of a batch."""
    high = np.array([_split(p)[0] for p in probes], np.int64)
    pairs = [_split(p) for p in probes]

    def of(h: np.ndarray, i: np.ndarray) -> np.ndarray:
        low, up = np.searchsorted(high, h, "left"), np.searchsorted(high, h, "right")
        for r in np.flatnonzero(low < up).tolist():  # a probe inside this hash
            up[r] = bisect_right(pairs, (int(h[r]), int(i[r])))
        return up

    return of


def _with_bucket(keys: DataFrame, probes: list[int], name: str) -> DataFrame:
    schema = T.StructType([*keys.schema.fields, T.StructField(name, T.IntegerType())])

    def run(batches):
        of = _bucket(probes)
        for b in batches:
            found = of(b.column("h").to_numpy(), b.column("i").to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.int32())], names=schema.names)

    return keys.mapInArrow(run, schema)


def _below(keys: DataFrame, probes: list[int]) -> list[tuple[int, int]]:
    """Bytes and rows of the keys under each probe (ascending)."""
    if not probes:
        return []
    counted = _with_bucket(keys, probes, "b").groupBy("b").agg(F.sum("size").alias("n"), F.count("*").alias("c")).collect()
    sums = {r["b"]: (r["n"], r["c"]) for r in counted}
    below, run, rows = [], 0, 0
    for b in range(len(probes)):
        n, c = sums.get(b, (0, 0))
        run, rows = run + n, rows + c
        below.append((run, rows))
    return below


def splitters(keys: DataFrame, shards: int, tolerance: float = TOLERANCE, probes: int = PROBES, group_slack: float = GROUP_SLACK) -> list[int]:
    """shards - 1 boundaries (128-bit keys); a row belongs to the shard numbered by the boundaries at or below its key."""
    total, rows = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    slack = total / shards * tolerance
    wanted = [total * s / shards for s in range(1, shards)]
    # Of each boundary: interval of keys, bytes and rows below its ends.
    state = [(0, _TOP, (0, 0), (total, rows)) for _ in wanted]
    found: list[int | None] = [None] * len(wanted)
    while any(x is None for x in found):
        tries = set()
        for (low, up, _, _), done in zip(state, found, strict=True):
            if done is None:
                tries.update(p for p in (low + (up - low) * k // (probes + 1) for k in range(1, probes + 1)) if low < p < up)
        ordered = sorted(tries)
        below = _below(keys, ordered)
        for s, target in enumerate(wanted):
            if found[s] is not None:
                continue
            low, up, at_low, at_up = state[s]
            for p, n in zip(ordered, below, strict=True):
                if low < p < up:
                    if n[0] <= target:
                        low, at_low = p, n
                    else:
                        up, at_up = p, n
                        break
            state[s] = (low, up, at_low, at_up)
            near = (low, at_low[0]) if target - at_low[0] <= at_up[0] - target else (up, at_up[0])
            if abs(near[1] - target) <= slack or up - low <= 1 or at_up[1] - at_low[1] <= 1:
                found[s] = near[0]
    cuts = _whole_groups(keys, found, wanted, total / shards * group_slack)
    return [max(cuts[: s + 1]) for s in range(len(cuts))]


def _whole_groups(keys: DataFrame, cuts: list[int], wanted: list[float], slack: float) -> list[int]:
    """Each boundary at the nearer end of the group (rows of one text hash) it lies in, if that end is within ``slack`` of its place."""
    ends = [((c >> 64) << 64, min((c >> 64) + 1 << 64, _TOP)) for c in cuts]
    ordered = sorted({p for e in ends for p in e})
    at = {p: n for p, (n, _) in zip(ordered, _below(keys, ordered), strict=True)}
    moved = []
    for cut, (low, up), target in zip(cuts, ends, wanted, strict=True):
        near = min(low, up, key=lambda p: abs(at[p] - target))
        moved.append(near if abs(at[near] - target) <= slack or at[low] == at[up] else cut)
    return moved


def _id_key() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-_HALF))


def _runs(cuts: list[int], runs: int) -> tuple[list[int], list[int]]:
    """Boundaries of the shards and of ``runs`` pieces of each, and the shard of every piece."""
    ends = [0, *cuts, _TOP + 1]
    inner = {low + (up - low) * k // runs for low, up in zip(ends, ends[1:], strict=False) for k in range(1, runs)}
    marks = sorted({*cuts, *inner})
    return marks, [0, *[bisect_right(cuts, m) for m in marks]]


def key_table(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the key (h, i) of every row, written once; the texts are read here only."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("h"),
        _id_key().alias("i"),
    )
    return materialize(narrow, "shard_keys")


def assign(spark: SparkSession, docs: DataFrame, shards: int = 40, runs: int = 8, tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0 in each shard, in key order).

    A shard is numbered in ``runs`` pieces of its hash range, so that no task
    sorts a whole shard; offsets of the pieces come from their row counts.
    """
    keys = key_table(spark, docs)
    cuts = splitters(keys, shards, tolerance)
    marks, shard_of = _runs(cuts, runs)
    placed = _with_bucket(keys, marks, "run")
    counts = {r["run"]: r["n"] for r in placed.groupBy("run").agg(F.count("*").alias("n")).collect()}
    table, shard, offset = [], 0, 0
    for run in range(len(marks) + 1):
        now = shard_of[run]
        shard, offset = now, 0 if now != shard else offset
        table.append((run, shard, offset))
        offset += counts.get(run, 0)
    start = F.broadcast(spark.createDataFrame(table, "run int, shard int, base long"))  # shards x runs rows
    order = Window.partitionBy("run").orderBy("h", "i", "size", "text_crc32")
    return (
        placed.withColumn("nth", F.row_number().over(order) - 1)
        .join(start, "run")
        .select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("nth")).alias("slot"))
    )


def digest(spark: SparkSession, docs: DataFrame, shards: int = 40) -> DataFrame:
    return assign(spark, docs, shards).select(
        "doc_id", "size", unsigned(F.col("text_crc32")).alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(spark: SparkSession, docs: DataFrame, path: str, shards: int = 40, runs: int = 8) -> None:
    """The documents as one folder per shard, in files of one piece of its hash range each, rows in slot order.

    Rows are placed by their own keys, so repeated and null ids stay as they are; the texts are exchanged once.
    """
    cuts = splitters(key_table(spark, docs), shards)
    marks, shard_of = _runs(cuts, runs)
    names = [fresh(n, docs.columns) for n in ("h", "i", "run")]
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64(text).alias("h"), _id_key().alias("i"))
    table = spark.createDataFrame([(r, shard_of[r]) for r in range(len(marks) + 1)], "run int, shard int")
    placed = _with_bucket(rows, marks, "run").join(F.broadcast(table), "run")  # shards x runs rows
    placed = placed.select("row.*", *[F.col(a).alias(b) for a, b in zip(("h", "i", "run"), names, strict=True)], "shard")
    ordered = placed.repartition(len(marks) + 1, names[2]).sortWithinPartitions("shard", names[2], names[0], names[1])
    ordered.drop(*names).write.partitionBy("shard").parquet(path)
