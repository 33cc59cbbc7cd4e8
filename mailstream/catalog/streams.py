"""Streaming runs and sinks as queries: run to the end, then read the result.

The lines of each topic are first written to the shared folder as message files,
which is what a topic looks like to a stream.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailstream.catalog import fixtures as fx
from mailstream.catalog.batch import blocks, isp_domains, lists, q_logs_rollup, q_union_logs
from mailstream.operators.rollup import union_rows
from mailstream.plans.schemas import (
    ACTIONS_REPORT,
    LOG_ARCHIVE,
    LOGS_REPORT,
    USER_AGENT_REPORT,
)
from mailstream.session import closing_batches, shared_folder
from mailstream.sources.files import file_source
from mailstream.sources.versions import (
    followed_blocks,
    followed_lookup,
    publish_blocks,
    publish_version,
)
from mailstream.streaming.agent_texts import AgentTexts
from mailstream.streaming.archive import read_archive
from mailstream.streaming.increments import (
    start_action_counts,
    start_agent_counts,
    start_log_batches,
)
from mailstream.streaming.jobs import (
    await_queries,
    start_actions,
    start_closed_log_days,
    start_log_archives,
    start_logs,
    start_user_agents,
)
from mailstream.streaming.sinks import (
    Trigger,
    read_csv_archive,
    snapshot_writer,
    write_csv_archive,
)
from mailstream.streaming.snapshot import SnapshotTable, publish, read_snapshot

MICRO_BATCHES = 3
ALL_NOW = Trigger(available_now=True)


def _topic_stream(spark: SparkSession, sf_dir: str, topic: str, folder: str) -> DataFrame:
    """A topic as message files, read in a few micro-batches."""
    files = max(MICRO_BATCHES, spark.sparkContext.defaultParallelism)
    path = f"{folder}/topics/{topic}"
    lines = fx.topic_lines(spark, sf_dir, topic).select("value")
    lines.repartition(files).write.parquet(path)
    return file_source(spark, path, max_files_per_trigger=ceil(files / MICRO_BATCHES))


def _third_of_topic(
    spark: SparkSession, sf_dir: str, topic: str, folder: str, part: int
) -> DataFrame:
    """A topic as message files, to which those of another third of the month are added.

    As many tasks write them as the join has, so no task holds a third.
    """
    path = f"{folder}/topics/{topic}"
    lines = fx.topic_lines(spark, sf_dir, topic)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts")
    dated = lines.join(events, "event_id")
    third = F.least(F.lit(MICRO_BATCHES - 1), F.floor((F.dayofmonth("ts") - 1) / 10))
    dated.where(third == part).select("value").write.mode("append").parquet(path)
    return file_source(spark, path)


def q_stream_logs_closed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the days that are closed when the topics end; their state is gone.

    A run goes on where the one before ended and takes a third of the month, whatever number
    of files that is, as one micro-batch; the last run closes the days that are over.
    """
    folder = shared_folder(spark, "closed")
    table = SnapshotTable(f"{folder}/report", LOGS_REPORT)
    for part in range(MICRO_BATCHES):
        bounces, deliveries = (
            _third_of_topic(spark, sf_dir, topic, folder, part) for topic in fx.LOG_EVENTS
        )
        with closing_batches(spark, part == MICRO_BATCHES - 1):
            queries = start_closed_log_days(
                bounces,
                deliveries,
                snapshot_writer(table),
                f"{folder}/checkpoints",
                trigger=ALL_NOW,
            )
            await_queries(queries)
    return read_snapshot(spark, table)


def q_stream_actions_versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report from micro-batches that follow versions of the lookup tables."""
    folder = shared_folder(spark, "versioned")
    table = SnapshotTable(f"{folder}/report", ACTIONS_REPORT, adds=True)
    publish_version(fx.isp_table(spark, sf_dir), f"{folder}/isp")
    publish_version(fx.list_table(spark, sf_dir), f"{folder}/lists")
    publish_blocks(
        fx.nation_blocks(spark, sf_dir), f"{folder}/blocks", fx.nation_blocks6(spark, sf_dir)
    )
    queries = start_action_counts(
        [(topic, _topic_stream(spark, sf_dir, topic, folder)) for topic in fx.ACTION_EVENTS],
        followed_lookup(f"{folder}/isp"),
        followed_lookup(f"{folder}/lists"),
        followed_blocks(f"{folder}/blocks"),
        table,
        f"{folder}/checkpoints",
        ALL_NOW,
    )
    await_queries(queries)
    return read_snapshot(spark, table)


def q_stream_actions_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "actions")
    table = SnapshotTable(f"{folder}/report", ACTIONS_REPORT)
    queries = start_actions(
        [(topic, _topic_stream(spark, sf_dir, topic, folder)) for topic in fx.ACTION_EVENTS],
        isp_domains(spark, sf_dir),
        lists(spark, sf_dir),
        blocks(spark, sf_dir),
        snapshot_writer(table),
        f"{folder}/checkpoints",
        ALL_NOW,
    )
    await_queries(queries)
    return read_snapshot(spark, table)


def q_stream_logs_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "logs")
    table = SnapshotTable(f"{folder}/report", LOGS_REPORT)
    queries = start_logs(
        _topic_stream(spark, sf_dir, "bounce", folder),
        _topic_stream(spark, sf_dir, "delivered", folder),
        snapshot_writer(table),
        f"{folder}/archive",
        f"{folder}/checkpoints",
        ALL_NOW,
    )
    await_queries(queries)
    return read_snapshot(spark, table)


def q_stream_logs_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report from a table that is compacted after every micro-batch."""
    folder = shared_folder(spark, "compacted")
    table = SnapshotTable(f"{folder}/report", LOGS_REPORT)
    queries = start_logs(
        _topic_stream(spark, sf_dir, "bounce", folder),
        _topic_stream(spark, sf_dir, "delivered", folder),
        snapshot_writer(table, compact_every=1),
        f"{folder}/archive",
        f"{folder}/checkpoints",
        ALL_NOW,
    )
    await_queries(queries)
    return read_snapshot(spark, table)


def q_stream_user_agent_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "user-agents")
    table = SnapshotTable(f"{folder}/report", USER_AGENT_REPORT)
    queries = start_user_agents(
        _topic_stream(spark, sf_dir, "click", folder),
        isp_domains(spark, sf_dir),
        f"{folder}/checkpoints",
        snapshot_writer(table),
        ALL_NOW,
    )
    await_queries(queries)
    return read_snapshot(spark, table)


def q_stream_user_agent_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report from micro-batches that parse each text once and keep its fields."""
    folder = shared_folder(spark, "agent-texts")
    table = SnapshotTable(f"{folder}/report", USER_AGENT_REPORT, adds=True)
    publish_version(fx.isp_table(spark, sf_dir), f"{folder}/isp")
    queries = start_agent_counts(
        _topic_stream(spark, sf_dir, "click", folder),
        followed_lookup(f"{folder}/isp"),
        AgentTexts(f"{folder}/texts"),
        table,
        f"{folder}/checkpoints",
        ALL_NOW,
    )
    await_queries(queries)
    return read_snapshot(spark, table)


def q_logs_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both folders that the archive streams fill, read back."""
    folder = shared_folder(spark, "archive")
    queries = start_log_archives(
        _topic_stream(spark, sf_dir, "bounce", folder),
        _topic_stream(spark, sf_dir, "delivered", folder),
        f"{folder}/archive",
        f"{folder}/checkpoints",
        ALL_NOW,
    )
    await_queries(queries)
    bounced, delivered = (
        read_csv_archive(spark, f"{folder}/archive/{name}", LOG_ARCHIVE)
        for name in ("bounced", "delivered")
    )
    return union_rows(bounced, delivered)


def _log_batches(spark: SparkSession, sf_dir: str, folder: str) -> SnapshotTable:
    table = SnapshotTable(f"{folder}/report", LOGS_REPORT, adds=True)
    queries = start_log_batches(
        _topic_stream(spark, sf_dir, "bounce", folder),
        _topic_stream(spark, sf_dir, "delivered", folder),
        table,
        f"{folder}/archive",
        f"{folder}/checkpoints",
        ALL_NOW,
        compact_every=2,
    )
    await_queries(queries)
    return table


def q_stream_logs_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of both topics from micro-batches that archive and count at once."""
    folder = shared_folder(spark, "batches")
    return read_snapshot(spark, _log_batches(spark, sf_dir, folder))


def q_logs_archive_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive of the same job."""
    folder = shared_folder(spark, "batches")
    _log_batches(spark, sf_dir, folder)
    return union_rows(
        *(
            read_archive(spark, f"{folder}/archive/{name}", LOG_ARCHIVE)
            for name in ("bounced", "delivered")
        )
    )


def q_logs_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows, written by a batch that is run twice."""
    path = f"{shared_folder(spark, 'backfill')}/logs"
    for _ in range(2):
        write_csv_archive(q_union_logs(spark, sf_dir), path)
    return read_csv_archive(spark, path, LOG_ARCHIVE)


def q_upsert_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All keys with a stale total first, then the right totals over them."""
    table = SnapshotTable(shared_folder(spark, "upsert"), LOGS_REPORT)
    current = q_logs_rollup(spark, sf_dir)
    publish(current.selectExpr("* except (total_count)", "0L as total_count"), 0, table)
    publish(current, 1, table)
    return read_snapshot(spark, table)


STREAM_QUERIES = {
    name.removeprefix("q_"): query
    for name, query in list(globals().items())
    if name.startswith("q_") and query.__module__ == __name__
}
