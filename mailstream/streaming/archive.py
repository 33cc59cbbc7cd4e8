"""A CSV archive in runs: the rows of one micro-batch, or of several merged ones.

`run=<first>-<last>/date=<day>/` holds the rows of the micro-batches from first to last.  A
run is complete once its `_SUCCESS` file is there.  Readers take the complete runs that no
larger complete run contains, so merging changes nothing for them: before a merged run is
complete they read its parts, afterwards the run itself.  The parts are deleted some
micro-batches later, for readers that began before.  A micro-batch that is replayed finds its
run, or one that contains it, and writes nothing.

Every `FANOUT` micro-batches the newest runs become one, every `FANOUT` of those again, and
so on; so a day has at most `FANOUT` runs of each size, however many micro-batches there were.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from mailstream.streaming.sinks import CSV_OPTIONS, as_before, one_line, stored_schema

FANOUT = 10
#: Micro-batches that a run is kept after it went into a larger one.
KEEP = 3

#: First and last micro-batch of a run.
Run = tuple[int, int]


def run_folder(path: str, run: Run) -> str:
    return f"{path}/run={run[0]}-{run[1]}"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def complete_runs(spark: SparkSession, path: str) -> list[Run]:
    """All complete runs, also those that a larger one contains."""
    pattern, files = _file_system(spark, f"{path}/run=*/_SUCCESS")
    names = [f.getPath().getParent().getName() for f in files.globStatus(pattern) or []]
    bounds = (name.removeprefix("run=").split("-") for name in names)
    return sorted((int(first), int(last)) for first, last in bounds)


def _contains(outer: Run, inner: Run) -> bool:
    return outer != inner and outer[0] <= inner[0] and inner[1] <= outer[1]


def live_runs(runs: list[Run]) -> list[Run]:
    """The runs that no other one contains: each micro-batch is in one of them.

    Runs are ordered by their first micro-batch; of those that begin together the longest
    one comes first, and contains what follows up to its end.
    """
    live: list[Run] = []
    for run in sorted(runs, key=lambda r: (r[0], -r[1])):
        if not live or run[1] > live[-1][1]:
            live.append(run)
    return live


def _write(rows: DataFrame, path: str, run: Run) -> None:
    """One file for each day, more for a day that is larger than a file should be."""
    writer = rows.hint("rebalance", "date").write.mode("overwrite").options(**CSV_OPTIONS)
    writer.partitionBy("date").csv(run_folder(path, run))


def _read(spark: SparkSession, path: str, runs: list[Run], schema: StructType) -> DataFrame:
    """Rows of some runs as they were written."""
    reader = spark.read.schema(stored_schema(schema)).options(**CSV_OPTIONS)
    reader = reader.option("nullValue", "\u0001").option("basePath", path)
    return reader.csv([run_folder(path, run) for run in runs]).select(*schema.names)


def archive_batch(rows: DataFrame, batch_id: int, path: str) -> None:
    """Write the rows of a micro-batch as a run, unless the archive has them."""
    run = (batch_id, batch_id)
    runs = complete_runs(rows.sparkSession, path)
    if run not in runs and not any(_contains(other, run) for other in runs):
        _write(one_line(rows), path, run)


def merge_due(
    spark: SparkSession, batch_id: int, path: str, merge: Callable[[list[Run], Run], None]
) -> None:
    """Merge the newest runs when this micro-batch completes a group, and delete old parts.

    `merge(parts, whole)` writes what the runs `parts` hold as the run `whole`.
    """
    width = FANOUT
    while (batch_id + 1) % width == 0:
        whole = (batch_id + 1 - width, batch_id)
        runs = complete_runs(spark, path)
        parts = [run for run in live_runs(runs) if _contains(whole, run)]
        if len(parts) > 1:
            merge(parts, whole)
        width *= FANOUT
    runs = complete_runs(spark, path)
    live = live_runs(runs)
    for run in set(runs) - set(live):
        holder = next(other for other in live if _contains(other, run))
        if holder[1] + KEEP <= batch_id:
            folder, files = _file_system(spark, run_folder(path, run))
            files.delete(folder, True)


def merge_runs(spark: SparkSession, batch_id: int, path: str, schema: StructType) -> None:
    """Merge the newest runs of a CSV archive; written values are written again as they are."""

    def merge(parts: list[Run], whole: Run) -> None:
        _write(_read(spark, path, parts, schema), path, whole)

    merge_due(spark, batch_id, path, merge)


def read_archive(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All archived rows; a filter on `date` reads the folders of those days."""
    runs = live_runs(complete_runs(spark, path))
    if not runs:
        raise ValueError(f"no archive at {path}")
    return as_before(_read(spark, path, runs, schema))
