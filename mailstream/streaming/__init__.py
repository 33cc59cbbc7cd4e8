"""Running jobs: triggers, sinks, result tables."""

from mailstream.streaming.jobs import (
    await_queries,
    start_actions,
    start_logs,
    start_user_agents,
)
from mailstream.streaming.sinks import (
    Trigger,
    jdbc_writer,
    read_csv_archive,
    snapshot_writer,
    start_console,
    start_csv_archive,
    start_upsert,
    write_csv_archive,
)
from mailstream.streaming.snapshot import SnapshotTable, compact, expire, publish, read_snapshot

__all__ = [
    "SnapshotTable",
    "Trigger",
    "await_queries",
    "compact",
    "expire",
    "jdbc_writer",
    "publish",
    "read_csv_archive",
    "read_snapshot",
    "snapshot_writer",
    "start_actions",
    "start_console",
    "start_csv_archive",
    "start_logs",
    "start_upsert",
    "start_user_agents",
    "write_csv_archive",
]
