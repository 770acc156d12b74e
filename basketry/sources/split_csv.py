"""CSV files with line breaks inside quotes, read by many tasks.

Spark cuts a file into byte ranges at line ends, which may lie inside quotes. A line end is the end
of a record if the number of quotes before it is even, so one pass counts the quotes of each range and a
second one, told whether its range begins inside quotes, puts lines together to records. What a
range's records lack at their ends is stitched from neighbouring ranges: a few fragments, whatever the
size of the file. The records are parsed by Spark's own CSV parser.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.session import materialize

# The task functions travel with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OPTIONS = {"quote": '"', "escape": '"'}
SEQ = "ingest_seq"
WHOLE, TAIL, INNER, HEAD, NAMES = range(5)  # a record; its beginning, middle and end where it lies in several ranges; a cut header's beginning
_RECORDS = "file string, start long, id long, kind int, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, id, line): lines end at a line feed only, so breaks inside quotes keep their carriage return."""
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"), F.col("value").alias("line"),
    )


def _open_ranges(lines: DataFrame) -> DataFrame:
    """(file, start, inside): whether each range begins inside quotes. One row for each range."""
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "start").agg(F.sum(quotes).alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("start")) - F.col("n")
    return counted.select("file", "start", (before % 2 == 1).alias("inside"))


def join_lines(lines: Iterator[tuple[str, int, int, str]], inside: dict[tuple[str, int], bool]) -> Iterator[tuple]:
    """Records and fragments (file, start, id, kind, text) of lines that come range by range."""
    at: tuple | None = None
    parts: list[str] = []
    head = odd = header = False  # the open parts began in an earlier range; their quotes are odd; they are a file's header
    first = 0

    def rest() -> Iterator[tuple]:
        if parts:
            yield (*at, first, NAMES if header else INNER if head else TAIL, "\n".join(parts))

    for file, start, number, line in lines:
        if (file, start) != at:
            yield from rest()
            at, parts, odd = (file, start), [], inside[file, start]
            head, header = odd, start == 0
        if not parts:
            first = number
        parts.append(line)
        odd ^= line.count('"') % 2 == 1
        if not odd:
            if not header:
                yield (*at, first, HEAD if head else WHOLE, "\n".join(parts))
            parts, head, header = [], False, False
    yield from rest()


def _records(lines: DataFrame) -> DataFrame:
    """(file, start, id, record) of all records, a record where it begins."""
    spark = lines.sparkSession
    ranges = {(r.file, r.start): r.inside for r in _open_ranges(lines).collect()}  # one row for each range
    sent = spark.sparkContext.broadcast(ranges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        held = []
        for made in join_lines(rows(), sent.value):
            held.append(made)
            if len(held) == 4096:
                yield _batch(held)
                held = []
        yield _batch(held)

    return lines.mapInArrow(run, _RECORDS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
    columns = list(zip(*rows, strict=True)) or [()] * 5
    names = ["file", "start", "id", "kind", "record"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _stitched(pieces: DataFrame) -> DataFrame:
    """Fragments put together: a tail, and the inner parts and the head that follow it in its file."""
    order = Window.partitionBy("file").orderBy("start", "id")
    fragments = pieces.where(F.col("kind") != WHOLE).withColumn("n", F.sum(F.col("kind").isin(TAIL, NAMES).cast("int")).over(order))
    part = F.struct("start", "id", "record")
    joined = fragments.groupBy("file", "n").agg(F.array_sort(F.collect_list(part)).alias("parts"), F.max("kind").alias("kind"))
    joined = joined.where(F.col("kind") != NAMES)
    return joined.select(
        "file", F.col("parts")[0]["start"].alias("start"), F.col("parts")[0]["id"].alias("id"),
        F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"),
    )


def read_split_csv(spark: SparkSession, path: str) -> DataFrame:
    """A headed CSV as text columns and ``ingest_seq``, which orders rows as the files have them.

    The rows are those of Spark's multi-line reader, which gives a whole file to one task. Two passes
    over the files, the second of which is written; nothing is shuffled but fragments and a count for each range.
    """
    names = spark.read.options(header=True, multiLine=True, **OPTIONS).csv(path).columns
    ddl = T.StructType([T.StructField(n, T.StringType()) for n in names]).toDDL()
    pieces = materialize(_records(_lines(spark, path)), "csv-records")
    whole = pieces.where(F.col("kind") == WHOLE).select("file", "start", "id", "record")
    records = whole.unionByName(_stitched(pieces))
    clean = F.regexp_replace(F.regexp_replace("record", r"\r$", ""), r"\r\n", "\n")
    filled = records.withColumn("record", clean).where("trim(record) <> ''")  # the reader passes over empty lines
    parsed = filled.withColumn("row", F.from_csv("record", ddl, OPTIONS))
    return parsed.select(*(F.col("row")[n].alias(n) for n in names), F.struct("file", "start", F.col("id").alias("row")).alias(SEQ))
