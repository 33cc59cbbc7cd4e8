"""File stand-in for a topic: the same `value BINARY` rows, from Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LINE_SCHEMA = "value binary"


def file_source(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of the message files under `path`."""
    reader = spark.readStream.schema(LINE_SCHEMA)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def file_lines(spark: SparkSession, path: str) -> DataFrame:
    """The same rows as a batch, for a backfill."""
    return spark.read.schema(LINE_SCHEMA).parquet(path)
