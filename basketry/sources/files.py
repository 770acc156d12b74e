"""CSV and JSON readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from basketry.functions.coercion import null_tokens_to_null
from basketry.sources.split_csv import SEQ, read_split_csv


def read_csv(spark: SparkSession, path: str, free_text: bool = False, sequence: bool = True) -> DataFrame:
    """A headed CSV as text columns, missing-value tokens nulled.

    ``free_text`` allows line breaks inside quotes; large files are cut into ranges all the same (``split_csv``).
    ``sequence`` adds ``ingest_seq``, which orders rows as the file has them.
    """
    reader = spark.read.options(header=True, quote='"', escape='"')
    try:
        df = read_split_csv(spark, path) if free_text else reader.csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no source file at {path}") from error
        raise
    if free_text:
        return null_tokens_to_null(df if sequence else df.drop(SEQ))
    if not sequence:
        return null_tokens_to_null(df)
    # Within one split, ids rise in reading order; splits are ordered by file and offset.
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )
    return null_tokens_to_null(df.withColumn(SEQ, place))


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Fetched JSON responses, one row per file: (payload)."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("payload"))


def parsed_item_count(value: Column) -> Column:
    """As ``payload_item_count``, of a parsed response: a VARIANT that may be null."""
    nested = F.size(F.try_variant_get(value, "$.products", "array<variant>"))
    return F.coalesce(nested, F.size(F.try_variant_get(value, "$", "array<variant>")), F.lit(0)).cast("long")


def payload_item_count(payload: Column) -> Column:
    """Entries of a response: the length of its ``products`` array or of a top-level array, else 0."""
    nested = F.json_array_length(F.get_json_object(payload, "$.products"))
    return F.coalesce(nested, F.json_array_length(payload), F.lit(0)).cast("long")
