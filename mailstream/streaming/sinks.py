"""Where results go: keyed tables, date-partitioned CSV files, the console.

Every query needs a checkpoint folder, so a restart goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from mailstream.sources.jdbc import JdbcTarget
from mailstream.streaming.jdbc_upsert import upsert_jdbc
from mailstream.streaming.snapshot import SnapshotTable, compact, expire, publish

COMPACT_EVERY = 50

BatchWriter = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class Trigger:
    """When micro-batches run: as soon as possible, every so often, or once over
    what is there now."""

    every: str | None = None
    available_now: bool = False

    def apply(self, writer: DataStreamWriter) -> DataStreamWriter:
        if self.available_now:
            return writer.trigger(availableNow=True)
        if self.every is not None:
            return writer.trigger(processingTime=self.every)
        return writer


def snapshot_writer(table: SnapshotTable, compact_every: int = COMPACT_EVERY) -> BatchWriter:
    """Publish to a file table and compact it every so many batches."""

    def write(batch: DataFrame, batch_id: int) -> None:
        publish(batch, batch_id, table)
        if batch_id % compact_every == compact_every - 1:
            compact(batch.sparkSession, table)
            expire(batch.sparkSession, table)

    return write


def jdbc_writer(target: JdbcTarget, table: str, connections: int = 16) -> BatchWriter:
    """Upsert into a database table."""

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_jdbc(batch, target, table, connections)

    return write


def start_upsert(
    rollup: DataFrame,
    write: BatchWriter,
    checkpoint: str,
    trigger: Trigger = Trigger(),
    mode: str = "update",
) -> StreamingQuery:
    """Hand the keys each micro-batch changed, with running totals, to `write`.

    In append mode each key comes once, when its day is closed.
    """
    writer = (
        rollup.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    return trigger.apply(writer).start()


# Blanks at the ends of a value are part of it; a quote inside one is doubled.
CSV_OPTIONS = {
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "escape": '"',
}
# What stands for characters that would split a row or its value, so that
# files can be read in parts.  The backslash is first written, and last read.
ESCAPES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\u0001", "\\x01"))
BACKFILL = "backfill"


def one_line(rows: DataFrame) -> DataFrame:
    """Text values without line breaks; `date`, which names folders, is left alone."""
    texts = [n for n, kind in rows.dtypes if kind == "string" and n != "date"]
    escaped = {}
    for name in texts:
        value = F.col(name)
        for plain, written in ESCAPES:
            value = F.replace(value, F.lit(plain), F.lit(written))
        escaped[name] = value
    return rows.withColumns(escaped) if escaped else rows


def as_before(rows: DataFrame) -> DataFrame:
    """Undo `one_line`.

    Doubled backslashes are set aside as a character that values no longer hold.
    """
    texts = [n for n, kind in rows.dtypes if kind == "string" and n != "date"]
    plain = {}
    for name in texts:
        value = F.replace(name, F.lit(ESCAPES[0][1]), F.lit("\u0001"))
        for character, written in ESCAPES[1:3]:
            value = F.replace(value, F.lit(written), F.lit(character))
        # A written \x01 and a set-aside backslash must not meet: split on the latter.
        parts = F.transform(
            F.split(value, "\u0001"),
            lambda part: F.replace(part, F.lit(ESCAPES[3][1]), F.lit(ESCAPES[3][0])),
        )
        plain[name] = F.array_join(parts, "\\")
    return rows.withColumns(plain) if plain else rows


def start_csv_archive(
    rows: DataFrame, path: str, checkpoint: str, trigger: Trigger = Trigger()
) -> StreamingQuery:
    """Append rows to CSV files without header, one folder per date."""
    writer = (
        one_line(rows)
        .writeStream.outputMode("append")
        .format("csv")
        .options(**CSV_OPTIONS)
        .partitionBy("date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return trigger.apply(writer).start()


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def write_csv_archive(rows: DataFrame, path: str, run: str = "0") -> None:
    """Files of a batch, beside those of a stream: a folder for each `run`.

    A stream's folder is read through the log of its sink, which knows nothing of files
    that others add; so they go to a folder of their own, which `read_csv_archive` reads
    too.  A run that is repeated replaces what it wrote before.

    Rows are gathered by date to avoid one file per task and date; adaptive
    execution splits a date that is larger than a file should be.
    """
    gathered = one_line(rows).hint("rebalance", "date")
    writer = gathered.write.mode("overwrite").options(**CSV_OPTIONS).partitionBy("date")
    writer.csv(f"{path}_{BACKFILL}/run={run}")


def stored_schema(schema: StructType) -> StructType:
    """Columns as files have them: the folder column goes last."""
    return StructType([field for field in schema if field.name != "date"] + [schema["date"]])


def read_csv_archive(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read an archive back, backfills included; a filter on `date` reads those folders.

    A NULL was written as nothing and an empty text as quotes; a null marker that
    occurs in neither keeps them apart.
    """
    reader = spark.read.schema(stored_schema(schema)).options(**CSV_OPTIONS).option("nullValue", "\u0001")
    folders = [f for f in (path, f"{path}_{BACKFILL}") if _exists(spark, f)]
    parts = [reader.csv(folder).select(*schema.names) for folder in folders]
    if not parts:
        raise ValueError(f"no archive at {path}")
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return as_before(rows)


def late_rows(query: StreamingQuery) -> int:
    """Rows that a query left out because their day was closed, as far as it remembers."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


def start_console(
    rollup: DataFrame, checkpoint: str, rows: int, trigger: Trigger = Trigger()
) -> StreamingQuery:
    """Preview up to `rows` of the keys each micro-batch changed, in full width.

    Spark's console brings all changed keys to the driver first: a help for looking at a
    job, not a sink for results.
    """
    writer = (
        rollup.writeStream.outputMode("update")
        .format("console")
        .option("truncate", "false")
        .option("numRows", str(rows))
        .option("checkpointLocation", checkpoint)
    )
    return trigger.apply(writer).start()
