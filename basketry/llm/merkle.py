"""Merkle manifest of a table: a tree of hashes per source, one over the sources, a proof per row.

Leaves are hashed at the scan; from there on only digests move. Rows get a gapless place in
their source from one range sort. A superblock is an aligned run of ``SUPERBLOCK`` leaves of one
source, so it reduces inside one task to one node whatever the size of its source. Two exchanges
by superblock follow: the first reduces every superblock to its top, and the tops are the leaves of
the same procedure, until one node a source is left; the second cogroups leaves with the outer nodes
their superblock needs (the siblings of its top up to the root) and there finishes the local
reduction, joins the proofs and folds them.

Defined cases: a null in any column is hashed as ``-``; null sources are a source of their own, the
first; a null id comes first in its source; rows of one id are ordered by their leaf, and equal rows
are leaves of their own; a table without rows gives no rows; columns that are not named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from basketry.session import materialize

ARITY = 3
DEPTH = 6  # levels inside a superblock
SUPERBLOCK = ARITY**DEPTH  # 729 leaves, about 100 KB of digests

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")  # fixed by the contract, in this order

_PATH = "array<struct<at: int, siblings: array<string>>>"
_NODE = "k string, p long, n long, h string"


def encoded(value: Column) -> Column:
    """``value`` as ``<bytes>:<value>``, a null as ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*(encoded(c) for c in columns)), 256)


def positions(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """``rows`` (stored) with ``p``, their gapless place within ``key`` (not null) by ``order``, and ``n``, the size of their key.

    One range exchange by (key, order), so that a key with a third of all rows is spread; each
    sorted partition numbers its own rows, and the counts per partition and key give the offsets.
    """
    schema = rows.select("*", F.lit(0).alias("part"), F.lit(0).cast("long").alias("i")).schema
    at = rows.columns.index(key)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, i = None, 0
        for batch in batches:
            places = []
            for name, run in groupby(batch.column(at).to_pylist()):
                size = sum(1 for _ in run)
                if name != current:
                    current, i = name, 0
                places.extend(range(i, i + size))
                i += size
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64())], schema=target)

    target = to_arrow_schema(schema)
    dealt = rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order).withColumn("part", F.spark_partition_id())
    numbered = materialize(dealt.mapInArrow(number, schema), "merkle-sorted")
    counts = numbered.groupBy(key, "part").agg(F.count(F.lit(1)).alias("c"))
    # A key has at most one count for each partition.
    same = Window.partitionBy(key)
    whole, before = F.sum("c").over(same), F.sum("c").over(same.orderBy("part")) - F.col("c")
    offsets = counts.select(key, "part", before.alias("before"), whole.alias("n"))
    return numbered.join(offsets, [key, "part"]).withColumn("p", F.col("before") + F.col("i")).drop("part", "i", "before")


def _digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def reduce_run(digests: list[str], more: bool) -> list[list[str]]:
    """The levels above ``digests``, themselves included: ``DEPTH`` of them where the source goes on outside, else up to one node."""
    levels = [digests]
    while len(levels) <= DEPTH if more else len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([_digest("".join(below[i : i + ARITY])) for i in range(0, len(below), ARITY)])
    return levels


def path_of(levels: list[list[str]], i: int) -> list[tuple[int, list[str]]]:
    """For each level the node's place in its run and the run's other members, left to right."""
    path = []
    for level in levels[:-1]:
        first, at = i - i % ARITY, i % ARITY
        run = level[first : first + ARITY]
        path.append((at, run[:at] + run[at + 1 :]))
        i //= ARITY
    return path


def fold(digest: str, path: Sequence[tuple[int, Sequence[str]]]) -> str:
    """The root that ``digest`` leads to with the siblings of ``path``."""
    for at, siblings in path:
        digest = _digest("".join((*siblings[:at], digest, *siblings[at:])))
    return digest


def _with_block(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("b", F.floor(F.col("p") / SUPERBLOCK))


def _tops(nodes: DataFrame) -> DataFrame:
    """The top of every superblock as a node of the next tree: (k, p, n, h)."""

    def top(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("p")
        first = group.iloc[0]
        levels = reduce_run(group["h"].tolist(), bool(first["n"] > SUPERBLOCK))
        return pd.DataFrame({"k": [first["k"]], "p": [first["b"]], "n": [-(-first["n"] // SUPERBLOCK)], "h": levels[-1]})

    blocks = _with_block(nodes.select("k", "p", "n", "h"))
    return materialize(blocks.groupBy("k", "b").applyInPandas(top, _NODE), "merkle-tops")


def outer_nodes(nodes: DataFrame) -> DataFrame:
    """(k, b, path, root) of every superblock of ``nodes``: the way from its top to the one node of its key.

    Each turn has a 729th of the rows of the one before.
    """
    tops = _tops(nodes)
    if tops.where("n > 1").isEmpty():
        return tops.select("k", F.col("p").alias("b"), F.array().cast(_PATH).alias("path"), F.col("h").alias("root"))

    def finish(group: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        levels, onward, root = _inside(group, outer)
        paths = [_rows(path_of(levels, i) + onward) for i in range(len(group))]
        return pd.DataFrame({"k": group["k"].values, "b": sorted(group["p"]), "path": paths, "root": root})

    return _exchange(tops, outer_nodes(tops), finish, f"k string, b long, path {_PATH}, root string")


def _inside(group: pd.DataFrame, outer: pd.DataFrame) -> tuple[list[list[str]], list[tuple[int, list[str]]], str]:
    """The levels of one superblock, and its one outer row: the way on and where it ends."""
    if len(outer) != 1:
        raise ValueError(f"a superblock has {len(outer)} outer rows")
    ordered = group.sort_values("p")
    levels = reduce_run(ordered["h"].tolist(), bool(ordered["n"].iloc[0] > SUPERBLOCK))
    onward = [(int(step["at"]), list(step["siblings"])) for step in outer["path"].iloc[0]]
    return levels, onward, outer["root"].iloc[0]


def _rows(path: list[tuple[int, list[str]]]) -> list[dict]:
    return [{"at": at, "siblings": siblings} for at, siblings in path]


def _exchange(nodes: DataFrame, outer: DataFrame, finish, schema: str) -> DataFrame:
    """Leaves and outer nodes of one superblock in one group: at most ``SUPERBLOCK`` rows and one."""
    left = _with_block(nodes).groupBy("k", "b")
    return left.cogroup(outer.groupBy("k", "b")).applyInPandas(finish, schema)


def _over_sources(outer: DataFrame) -> DataFrame:
    """``outer`` with the way on through the tree of the sources: path goes to the root, ``subroot`` is kept."""
    subroots = outer.where("b = 0").select("k", F.col("root").alias("h"))
    ranked = positions(materialize(subroots.withColumn("whole", F.lit("")), "merkle-subroots"), "whole", ["k"])
    sources = ranked.select(F.col("whole").alias("k"), "p", "n", "h", F.col("k").alias("source_key"))

    def finish(group: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        levels, onward, root = _inside(group, above)
        ordered = group.sort_values("p")
        paths = [_rows(path_of(levels, i) + onward) for i in range(len(ordered))]
        return pd.DataFrame({"k": ordered["source_key"].values, "onward": paths, "top": root})

    sources = materialize(sources, "merkle-sources")
    ways = _exchange(sources, outer_nodes(sources), finish, f"k string, onward {_PATH}, top string")
    return outer.join(ways, "k").select(
        "k", "b", F.concat("path", "onward").alias("path"), F.col("root").alias("subroot"), F.col("top").alias("root")
    )


def manifest(
    docs: DataFrame, claimed: dict[str, Column] | None = None, columns: Sequence[str] = COLUMNS,
    id_column: str = "doc_id", source: str = "source", paths: bool = False,
) -> DataFrame:
    """(id, source, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    The manifest is that of ``docs``. ``claimed`` says how the rows to verify differ from them (a
    column's name and its value); ``folded_root`` is what the claimed row's leaf gives with the
    original siblings, and ``verified`` whether that is the root. ``proof_sha256`` hashes the
    siblings from the leaf up, left to right; ``paths`` adds them as the column ``path``.
    """
    claimed = claimed or {}
    original = leaf_hash([F.col(c) for c in columns])
    changed = leaf_hash([claimed.get(c, F.col(c)) for c in columns])
    differs = F.lit(False)
    for name, value in claimed.items():
        differs = differs | ~F.col(name).eqNullSafe(value)
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")).alias("k"),  # null first, bytewise
        F.col(id_column).alias("id"), original.alias("h"), F.when(differs, changed).alias("other"),
    )
    numbered = positions(materialize(leaves, "merkle-leaves"), "k", ["id", "h", "other"])
    # As text, for pandas would make doubles of whole numbers beside a null.
    placed = materialize(numbered.withColumn("id", F.col("id").cast("string")), "merkle-placed")
    outer = _over_sources(materialize(outer_nodes(placed), "merkle-outer"))

    def finish(group: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("p")
        levels, onward, root = _inside(group, above)
        rest = "".join("".join(siblings) for _, siblings in onward)
        whole = levels[-1][0]
        end = fold(whole, onward)  # where every row arrives whose claim holds
        proofs, folded, ways = [], [], []
        for i, (leaf, other) in enumerate(zip(group["h"], group["other"], strict=True)):
            path = path_of(levels, i)
            proofs.append(_digest("".join("".join(siblings) for _, siblings in path) + rest))
            top = fold(other if isinstance(other, str) else leaf, path)
            folded.append(end if top == whole else fold(top, onward))
            if paths:
                ways.append(_rows(path + onward))
        out = pd.DataFrame({
            "id": group["id"].values, "k": group["k"].values, "leaf": group["h"].values, "subroot": above["subroot"].iloc[0],
            "root": root, "proof_sha256": proofs, "folded_root": folded,
        })
        out["verified"] = out["folded_root"] == root
        if paths:
            out["path"] = ways
        return out

    schema = "id string, k string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    found = _exchange(placed, outer, finish, schema + (f", path {_PATH}" if paths else ""))
    identity = F.col("id").cast(docs.schema[id_column].dataType).alias(id_column)
    named = F.when(F.col("k") != "", F.expr("substr(k, 2)")).alias(source)
    return found.select(identity, named, *found.columns[2:])


def digest(docs: DataFrame) -> DataFrame:
    """The contract's rows: every second document by the hash of its id has the line ends of its text deleted before it is verified."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.when(tampered, F.translate("text", "\n", "")).otherwise(F.col("text"))
    rows = manifest(docs.select(*COLUMNS), {"text": text})
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "source")
