"""The clickstream preparation over a stream of landed files.

The same row rules as the batch. Two things differ, as a stream has no end: an
event id is remembered for the watermark's length only, and event codes come
from a dictionary fixed beforehand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from basketry.plans.prepare import clean_events


def read_events(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def prepare_events(events: DataFrame, codes: DataFrame, delay: str = "1 hour", fmt: str | None = None) -> DataFrame:
    """Dedup within the watermark, drop unlinked rows, hour, dwell time, event code.

    ``codes`` is (value, code), the small dictionary of a batch run. ``delay`` must
    cover how late events come. Rows without a readable time have no place in the
    watermark; they are passed on as they are.
    """
    cleaned = clean_events(events, fmt)
    cleaned = cleaned.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    timed = cleaned.where(F.col("event_timestamp").isNotNull()).withWatermark("event_timestamp", delay)
    unique = timed.dropDuplicatesWithinWatermark(["event_id"])
    unique = unique.unionByName(cleaned.where(F.col("event_timestamp").isNull()))
    joined = unique.join(codes, unique["event_type"] == codes["value"], "left")
    return joined.withColumn("event_type_encoded", F.coalesce("code", F.lit(-1)).cast("int")).drop("value", "code")


def write_events(prepared: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append whatever has landed, then stop; a later run goes on from the checkpoint."""
    writer = prepared.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    return writer.option("checkpointLocation", checkpoint).start(path)
