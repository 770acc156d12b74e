"""Helpers of the text operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.words import SPACE, Words, find_words, text_chunks
from basketry.session import small_batches as small_batches


def fresh(name: str, columns: Iterable[str]) -> str:
    """``name``, with underscores added until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """A task function that gives back what Arrow's pool and the C heap still hold at its end: idle workers wait beside busy ones."""

    @wraps(run)
    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim is not None:
            trim(0)

    return released


def string_column(values: Iterable[str | None]) -> pa.Array:
    return pa.array(values, pa.string())


def append_columns(
    df: DataFrame, text_column: str, fields: list[T.StructField], compute: Callable[[pa.Array], list[pa.Array]]
) -> DataFrame:
    """All rows and columns of ``df`` and the given new ones, computed from the texts of each Arrow batch.

    A column of ``df`` with the name of a new one is replaced.
    """
    new = {f.name.lower() for f in fields}
    kept = [c for c in df.columns if c.lower() not in new]
    inputs = list(kept)
    hidden = None
    if text_column not in inputs:  # the text itself is replaced
        hidden = fresh("__text", df.columns)
        df = df.withColumn(hidden, F.col(text_column))
        inputs.append(hidden)
    source = hidden or text_column
    schema = T.StructType([df.schema[c] for c in kept] + fields)

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = compute(batch.column(source))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + made, names=kept + [f.name for f in fields])

    return df.select(*[F.col(f"`{c}`") for c in inputs]).mapInArrow(run, schema)


def map_words(
    df: DataFrame,
    id_column: str,
    text_column: str,
    schema: str,
    emit: Callable[[np.ndarray, Words], list | None],
    separators: np.ndarray = SPACE,
    lower: np.ndarray | None = None,
    among: KeyFilter | None = None,
) -> DataFrame:
    """Rows that ``emit`` makes from (ids, words) of each chunk of documents; null ids must be gone before.

    With ``among``, a filter of hashes of ids, documents that are not in it for certain are left out.
    """
    sent = None if among is None else df.sparkSession.sparkContext.broadcast(among)

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if sent is not None:
                batch = batch.filter(pa.array(sent.value.may_hold(batch.column(2).to_numpy().view(np.uint64))))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for a, b, data, offsets in text_chunks(batch.column(1)):
                found = emit(ids[a:b], find_words(data if lower is None else lower[data], offsets, separators))
                if found is not None:
                    yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in found], names=names)

    names = [f.name for f in T._parse_datatype_string(schema).fields]
    own = F.col(id_column).cast("long")
    hashed = [] if sent is None else [F.xxhash64(own).alias("__hash")]
    return df.select(own, F.col(text_column), *hashed).mapInArrow(run, schema)


def binary_column(blobs: Iterable[bytes]) -> pa.Array:
    return pa.array(blobs, pa.binary())


def unsigned(x: Column) -> Column:
    """The low 32 bits of an integer, as a long."""
    return x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))


class KeyFilter:
    """A bit for each hash of a set of keys: says no only to keys that are not in it. Its size is fixed."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        at = keys.astype(np.uint64) >> np.uint64(64 - (8 * len(self.bits)).bit_length() + 1)
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


_BITMAP = 32768  # bits of one bitmap of Spark's bitmap functions


def key_filter(keys: DataFrame, column: str, log2_bits: int) -> KeyFilter:
    """The filter of a column of mixed 64-bit keys; at most 2**log2_bits bits reach the driver."""
    at = F.shiftrightunsigned(F.col(column), 64 - log2_bits) + 1
    maps = keys.groupBy(F.bitmap_bucket_number(at).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("m"))
    bits = np.zeros((1 << log2_bits) // 8, np.uint8)
    for r in maps.toLocalIterator():
        first = (r["k"] - 1) * _BITMAP // 8
        part = np.frombuffer(r["m"], np.uint8)
        bits[first : first + len(part)] = part
    return KeyFilter(bits)


def split_by_keys(
    rows: DataFrame,
    keys: DataFrame | KeyFilter,
    column: str,
    log2_bits: int = 24,
    rest: tuple[Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose ``column`` (long) may be among that of ``keys`` (or a filter of its hashes), and those where it is not for certain.

    By a broadcast filter of fixed size, so that a join with few keys need not shuffle
    all rows. The first part still has to be joined. ``rest``, a task function and its schema, is applied to the
    second part in the same task: another function behind it would take another worker for each core.
    """
    name = fresh("__hash", rows.columns)
    if not isinstance(keys, KeyFilter):
        keys = key_filter(keys.select(F.xxhash64(column).alias("h")), "h", log2_bits)
    sent = rows.sparkSession.sparkContext.broadcast(keys)
    schema = rows.schema

    def part(wanted: bool, then: Callable, made: T.StructType | str) -> DataFrame:
        def chosen(batches):
            for b in batches:
                held = sent.value.may_hold(b.column(name).to_numpy().view(np.uint64))
                yield b.select(schema.names).filter(pa.array(held == wanted))

        @releasing
        def run(batches):
            yield from then(chosen(batches))

        return rows.withColumn(name, F.xxhash64(column)).mapInArrow(run, made)

    return part(True, iter, schema), part(False, *(rest or (iter, schema)))
