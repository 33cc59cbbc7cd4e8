"""Keyed result table on files, updated by micro-batches.

A micro-batch writes only the rows it changed, to `changes/batch=<id>`; the whole
table is never rewritten for it.  Compacting folds the changes so far into
`base/batch=<id>/date=<day>`, for the days they touch and no others.  Reading takes
the newest value of each key over both.  A batch folder counts once its `_SUCCESS`
file is there, so a half-written one is never read and a replayed batch leaves the
table as it was.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from mailstream.operators.rollup import TOTAL
from mailstream.session import adaptive

BATCH = "batch"
#: No file of changes has more rows; a day gets as many files when it is compacted.
ROWS_PER_FILE = 1_000_000
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
QUERY_ID = "sql.streaming.queryId"


@dataclass(frozen=True)
class SnapshotTable:
    """Where the table lies and its columns; all but the total are its key.

    The compacted part is partitioned by `partition_by`, a key column with few
    values, so a report on a few days reads only those.  The totals of a key replace
    each other, or add up if the table `adds`.
    """

    path: str
    schema: StructType
    partition_by: str = "date"
    adds: bool = False

    @property
    def keys(self) -> list[str]:
        return [name for name in self.schema.names if name != TOTAL]


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def _published(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the complete sub-folders of `changes` or `base`, ascending."""
    pattern, files = _file_system(spark, f"{folder}/*=*/_SUCCESS")
    found = files.globStatus(pattern) or []
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)


def _claim(spark: SparkSession, table: SnapshotTable, query_id: str) -> None:
    """Batch numbers mean something only within one query, so a table takes the
    batches of the first query that wrote to it and of no other."""
    pattern, files = _file_system(spark, f"{table.path}/query=*")
    owners = [f.getPath().getName().split("=")[1] for f in files.globStatus(pattern) or []]
    if owners and owners != [query_id]:
        raise ValueError(
            f"{table.path} belongs to streaming query {owners[0]}: restart with its "
            "checkpoint or publish to a new path"
        )
    if not owners:
        mark, files = _file_system(spark, f"{table.path}/query={query_id}")
        files.create(mark, True).close()


def is_published(spark: SparkSession, table: SnapshotTable, batch_id: int) -> bool:
    """Whether the table holds a micro-batch, in its changes or its newest base."""
    bases = _published(spark, f"{table.path}/base")
    folded = bool(bases) and batch_id <= bases[-1]
    return folded or batch_id in _published(spark, f"{table.path}/changes")


def publish(
    batch: DataFrame,
    batch_id: int,
    table: SnapshotTable,
    versions: Mapping[str, int] | None = None,
) -> None:
    """Add the rows that a micro-batch changed; does nothing when it is a replay.

    `versions` names the versions of the lookup tables that the rows were made with.
    """
    spark = batch.sparkSession
    query_id = spark.sparkContext.getLocalProperty(QUERY_ID)
    if query_id is not None:
        _claim(spark, table, query_id)
    if is_published(spark, table, batch_id):
        return
    if versions is not None:
        # Written first: versions without a published batch are those of a failed attempt.
        path, files = _file_system(spark, f"{table.path}/versions/batch={batch_id}.json")
        stream = files.create(path, True)
        stream.write(bytearray(json.dumps({BATCH: batch_id, **versions}), "utf-8"))
        stream.close()
    # Adaptive execution deals the rows to files by their size, in one pass.
    with adaptive(spark):
        dealt = batch.select(*table.schema.names).hint("rebalance")
        writer = dealt.write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE)
        writer.parquet(f"{table.path}/changes/batch={batch_id}")


def batch_versions(spark: SparkSession, table: SnapshotTable) -> DataFrame:
    """A row for each published micro-batch that named versions: batch and those versions."""
    named = spark.read.json(f"{table.path}/versions")
    bases = _published(spark, f"{table.path}/base")
    # One number for each published batch that no base holds yet.
    pending = [n for n in _published(spark, f"{table.path}/changes") if not bases or n > bases[-1]]
    folded = F.lit(False) if not bases else F.col(BATCH) <= bases[-1]
    return named.where(folded | F.col(BATCH).isin(pending))


def _read(spark: SparkSession, table: SnapshotTable, kind: str, batches: list[int]) -> DataFrame:
    """Rows of some batch folders, with the number of their batch."""
    schema = StructType([*table.schema.fields, StructField(BATCH, LongType())])
    if not batches:
        return spark.createDataFrame([], schema)
    folder = f"{table.path}/{kind}"
    files = spark.read.schema(schema).option("basePath", folder).parquet(
        *(f"{folder}/batch={n}" for n in batches)
    )
    return files.select(*schema.names)


def _newest(rows: DataFrame, table: SnapshotTable) -> DataFrame:
    total = F.sum(TOTAL) if table.adds else F.max_by(TOTAL, BATCH)
    return rows.groupBy(*table.keys).agg(total.alias(TOTAL)).select(*table.schema.names)


def _pending(spark: SparkSession, table: SnapshotTable, bases: list[int]) -> list[int]:
    """Published changes that no base holds yet."""
    done = bases[-1] if bases else -1
    return [n for n in _published(spark, f"{table.path}/changes") if n > done]


def _newest_bases(spark: SparkSession, table: SnapshotTable, bases: list[int]) -> dict[str, int]:
    """The last base that holds each partition value, by the names of folders.

    Compacting writes all keys of the days it touches, so older bases of a day are stale.
    """
    newest: dict[str, int] = {}
    for n in bases:
        pattern, files = _file_system(
            spark, f"{table.path}/base/batch={n}/{table.partition_by}=*"
        )
        for found in files.globStatus(pattern) or []:
            newest[found.getPath().getName().split("=", 1)[1]] = n
    return newest


def _current_base(spark: SparkSession, table: SnapshotTable, bases: list[int]) -> DataFrame:
    """Base rows that no later base replaces; no key occurs twice."""
    rows = _read(spark, table, "base", bases)
    if len(bases) < 2:
        return rows
    newest = _newest_bases(spark, table, bases)
    # One row for each day folder, which the driver has listed.
    valid = spark.createDataFrame(list(newest.items()), "__day string, __batch bigint")
    day = F.coalesce(F.col(table.partition_by).cast("string"), F.lit(NO_VALUE))
    same = (day == F.col("__day")) & (F.col(BATCH) == F.col("__batch"))
    return rows.join(F.broadcast(valid), same, "left_semi")


def _on_touched(rows: DataFrame, touched: DataFrame, day: str, how: str) -> DataFrame:
    return rows.join(touched, rows[day].eqNullSafe(touched["__day"]), how)


def read_snapshot(spark: SparkSession, table: SnapshotTable) -> DataFrame:
    """The current rows: the newest total of every key.

    Only days with pending changes are grouped; the others are read as they are.
    """
    bases = _published(spark, f"{table.path}/base")
    base = _current_base(spark, table, bases)
    pending = _pending(spark, table, bases)
    if not pending:
        return base.select(*table.schema.names)
    changes = _read(spark, table, "changes", pending)
    if not bases:
        return _newest(changes, table)
    day = table.partition_by
    touched = changes.select(F.col(day).alias("__day")).distinct()
    mixed = _on_touched(base, touched, day, "left_semi").unionByName(changes)
    still = _on_touched(base, touched, day, "left_anti").select(*table.schema.names)
    return _newest(mixed, table).unionByName(still)


def compact(spark: SparkSession, table: SnapshotTable) -> None:
    """Fold the pending changes into a new base; readers switch when it is done.

    Only days that occur in the changes are read and written.  A day gets as many files
    as its rows need, counted before; so one large day is split and small days are not,
    inside a stream as well, which has no adaptive execution.
    """
    bases = _published(spark, f"{table.path}/base")
    pending = _pending(spark, table, bases)
    if not pending:
        return
    day = table.partition_by
    rows = _read(spark, table, "changes", pending)
    touched = rows.select(F.col(day).alias("__day")).distinct()
    if bases:
        base = _current_base(spark, table, bases)
        rows = _on_touched(base, touched, day, "left_semi").unionByName(rows)
    counts = rows.groupBy(F.col(day).alias("__day")).agg(
        F.ceil(F.count("*") / ROWS_PER_FILE).alias("__files")
    )
    newest = _newest(rows, table)
    dealt = newest.join(counts, newest[day].eqNullSafe(counts["__day"])).withColumn(
        "__file", F.pmod(F.xxhash64(*table.keys), F.col("__files"))
    )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(tasks, day, "__file").select(*table.schema.names)
    target = f"{table.path}/base/batch={pending[-1]}"
    dealt.write.mode("overwrite").partitionBy(day).parquet(target)


def _delete(spark: SparkSession, folder: str) -> None:
    path, files = _file_system(spark, folder)
    files.delete(path, True)


def expire(spark: SparkSession, table: SnapshotTable) -> None:
    """Delete what the base before the newest one has replaced.

    What only the newest one has replaced stays, for readers that began earlier.
    """
    bases = _published(spark, f"{table.path}/base")
    if len(bases) < 2:
        return
    for n in _published(spark, f"{table.path}/changes"):
        if n <= bases[-2]:
            _delete(spark, f"{table.path}/changes/batch={n}")
    replaced: set[str] = set()
    for n in reversed(bases[:-1]):
        folder = f"{table.path}/base/batch={n}"
        pattern, files = _file_system(spark, f"{folder}/{table.partition_by}=*")
        parts = {f.getPath().getName() for f in files.globStatus(pattern) or []}
        if parts <= replaced:
            _delete(spark, folder)
        else:
            for part in parts & replaced:
                _delete(spark, f"{folder}/{part}")
        replaced |= parts
