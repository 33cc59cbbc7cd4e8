"""The three jobs: which queries each one starts, and waiting for them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from mailstream.functions.agents import BROWSERS, SYSTEMS, Rule
from mailstream.operators.decode import decode_bounces, decode_deliveries
from mailstream.operators.geo import GeoBlocks
from mailstream.operators.lookup import Lookup
from mailstream.operators.rollup import closed_days_rollup, rollup_all_columns, union_rows
from mailstream.plans.actions import actions_rollup
from mailstream.plans.user_agents import user_agent_rollup
from mailstream.streaming.sinks import (
    BatchWriter,
    Trigger,
    start_console,
    start_csv_archive,
    start_upsert,
)


def start_actions(
    topics: Iterable[tuple[str, DataFrame]],
    isp_domains: Lookup,
    lists: Lookup,
    blocks: GeoBlocks,
    write: BatchWriter,
    checkpoint: str,
    trigger: Trigger = Trigger(),
) -> list[StreamingQuery]:
    """Running counts of opens, clicks and unsubscribes; topics as (label, lines)."""
    counts = actions_rollup(topics, isp_domains, lists, blocks)
    return [start_upsert(counts, write, f"{checkpoint}/actions", trigger)]


def start_log_archives(
    bounces: DataFrame,
    deliveries: DataFrame,
    archive: str,
    checkpoint: str,
    trigger: Trigger = Trigger(),
) -> list[StreamingQuery]:
    """An archive of the rows of each topic."""
    rows = {"bounced": decode_bounces(bounces), "delivered": decode_deliveries(deliveries)}
    return [
        start_csv_archive(part, f"{archive}/{name}", f"{checkpoint}/{name}", trigger)
        for name, part in rows.items()
    ]


def start_logs(
    bounces: DataFrame,
    deliveries: DataFrame,
    write: BatchWriter,
    archive: str,
    checkpoint: str,
    trigger: Trigger = Trigger(),
) -> list[StreamingQuery]:
    """Running counts of both topics, and an archive of the rows of each.

    Three queries with a checkpoint each; each topic is read twice, once per query that uses
    it, as state can only be kept by a query of its own.  `start_log_batches` reads it once.
    """
    counts = rollup_all_columns(union_rows(decode_bounces(bounces), decode_deliveries(deliveries)))
    return [
        *start_log_archives(bounces, deliveries, archive, checkpoint, trigger),
        start_upsert(counts, write, f"{checkpoint}/counts", trigger),
    ]


def start_closed_log_days(
    bounces: DataFrame,
    deliveries: DataFrame,
    write: BatchWriter,
    checkpoint: str,
    delay: str = "1 day",
    trigger: Trigger = Trigger(),
) -> list[StreamingQuery]:
    """Counts of both topics for days that are closed; an optional extra.

    The running counts of `start_logs` never give up a key.  Here state ends with its day, at
    the price that rows which come later than `delay` after their day are left out, as are
    rows without a date; the archive has them all.
    """
    rows = union_rows(decode_bounces(bounces), decode_deliveries(deliveries))
    counts = closed_days_rollup(rows, delay)
    return [start_upsert(counts, write, f"{checkpoint}/closed_days", trigger, mode="append")]


def start_user_agents(
    lines: DataFrame,
    isp_domains: Lookup,
    checkpoint: str,
    write: BatchWriter,
    trigger: Trigger = Trigger(),
    preview_rows: int = 0,
    browsers: Sequence[Rule] = BROWSERS,
    systems: Sequence[Rule] = SYSTEMS,
) -> list[StreamingQuery]:
    """Running counts per device, with a preview on the console if rows are asked for.

    The preview is a query of its own: no result exists only on the console.
    """
    counts = user_agent_rollup(lines, isp_domains, browsers, systems)
    queries = [start_upsert(counts, write, f"{checkpoint}/user_agents", trigger)]
    if preview_rows:
        queries.append(start_console(counts, f"{checkpoint}/preview", preview_rows, trigger))
    return queries


def await_queries(queries: Sequence[StreamingQuery], poll_seconds: int = 5) -> None:
    """Wait until all queries have ended; when one fails, stop the rest and raise."""
    try:
        waiting = list(queries)
        while waiting:
            waiting = [q for q in waiting if not q.awaitTermination(poll_seconds)]
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
