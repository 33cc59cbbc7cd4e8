"""Run a job: `spark-submit ... -m mailstream actions --kafka host:9092 ...`.

Credentials come from the environment (DATABASE_USER, DATABASE_PASS), so they do
not show up in process lists.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from mailstream.functions.agents import BROWSERS, SYSTEMS, Rule, rules_from_json
from mailstream.operators.geo import geo_blocks
from mailstream.operators.lookup import Lookup, lookup_table
from mailstream.plans.schemas import ACTIONS_REPORT, LOGS_REPORT, USER_AGENT_REPORT
from mailstream.session import build_session
from mailstream.sources.geo import read_geo_blocks, read_geo_blocks6
from mailstream.sources.jdbc import (
    ACTIONS_TABLE,
    DIMENSION_DATABASE,
    ISP_TABLE,
    LIST_TABLE,
    LOGS_TABLE,
    RESULT_DATABASE,
    USER_AGENT_TABLE,
    JdbcTarget,
    jdbc_dim_source,
    mysql_url,
)
from mailstream.sources.kafka import ACTION_TOPICS, LOG_TOPICS, kafka_source
from mailstream.sources.versions import followed_blocks, followed_lookup
from mailstream.streaming.agent_texts import AgentTexts
from mailstream.streaming.increments import (
    start_action_counts,
    start_agent_counts,
    start_log_batches,
)
from mailstream.streaming.jobs import (
    await_queries,
    start_actions,
    start_logs,
    start_user_agents,
)
from mailstream.streaming.sinks import BatchWriter, Trigger, jdbc_writer, snapshot_writer
from mailstream.streaming.snapshot import SnapshotTable

JOBS = {
    "actions": (ACTIONS_TABLE, ACTIONS_REPORT),
    "logs": (LOGS_TABLE, LOGS_REPORT),
    "user-agents": (USER_AGENT_TABLE, USER_AGENT_REPORT),
}


def parser() -> argparse.ArgumentParser:
    options = argparse.ArgumentParser(prog="mailstream", description=__doc__)
    options.add_argument("job", choices=sorted(JOBS))
    options.add_argument("--kafka", required=True, help="host:port list of the brokers")
    options.add_argument("--checkpoint", required=True, help="folder all executors share")
    options.add_argument("--database-host", default="localhost")
    options.add_argument("--database-port", type=int, default=3306)
    options.add_argument("--report", help="folder of the result table instead of the database")
    options.add_argument("--archive", help="folder of the CSV archive (logs)")
    options.add_argument(
        "--micro-batches", action="store_true",
        help="add up counts of micro-batches in --report, without state; actions and "
        "user-agents then follow --lookup-versions, logs read each topic once",
    )
    options.add_argument(
        "--lookup-versions",
        help="folder of isp_domains, lists and blocks versions (actions, user-agents)",
    )
    options.add_argument(
        "--agent-texts", help="folder of the parsed user agents (user-agents, --micro-batches)"
    )
    options.add_argument("--networks", help="CSV of CIDR networks (actions)")
    options.add_argument("--places", help="CSV of the networks' countries (actions)")
    options.add_argument("--click-label", default="click", help="label of click rows (actions)")
    options.add_argument("--unsub-label", default="unsub", help="label of unsubscribe rows (actions)")
    options.add_argument("--topic", default=ACTION_TOPICS["click"], help="topic (user-agents)")
    options.add_argument(
        "--console", type=int, default=0, metavar="ROWS", help="preview rows (user-agents)"
    )
    options.add_argument("--agent-rules", help="JSON file of more rules (user-agents)")
    options.add_argument("--no-fail-on-data-loss", action="store_true")
    options.add_argument("--max-offsets", type=int, help="messages per micro-batch and topic")
    options.add_argument("--cache-lookups", action="store_true")
    options.add_argument(
        "--lookup-bounds", type=int, nargs=2, metavar=("LOW", "HIGH"),
        help="smallest and largest id of the lookup tables: read them in slices",
    )
    options.add_argument("--every", help="interval between micro-batches, like '30 seconds'")
    options.add_argument("--once", action="store_true", help="stop when all is read")
    return options


def _database(args: argparse.Namespace, name: str) -> JdbcTarget:
    return JdbcTarget(
        mysql_url(args.database_host, args.database_port, name),
        os.environ.get("DATABASE_USER", ""),
        os.environ.get("DATABASE_PASS", ""),
    )


def _topic(spark: SparkSession, args: argparse.Namespace, topic: str) -> DataFrame:
    return kafka_source(
        spark, args.kafka, topic, not args.no_fail_on_data_loss, args.max_offsets
    )


def _lookup(spark: SparkSession, args: argparse.Namespace, table: str) -> Lookup:
    slices = {}
    if args.lookup_bounds:
        slices = {"partition_column": "id", "bounds": tuple(args.lookup_bounds)}
    source = jdbc_dim_source(spark, _database(args, DIMENSION_DATABASE), table, **slices)
    return lookup_table(source, cache=args.cache_lookups)


def _writer(args: argparse.Namespace, table: str, schema: StructType) -> BatchWriter:
    if args.report:
        return snapshot_writer(SnapshotTable(args.report, schema))
    return jdbc_writer(_database(args, RESULT_DATABASE), table)


def _action_topics(spark: SparkSession, args: argparse.Namespace) -> list[tuple[str, DataFrame]]:
    labels = {"open": "open", "click": args.click_label, "unsub": args.unsub_label}
    return [(labels[name], _topic(spark, args, ACTION_TOPICS[name])) for name in labels]


def _rules(args: argparse.Namespace) -> tuple[Sequence[Rule], Sequence[Rule]]:
    """Rules of browsers and of systems."""
    return rules_from_json(args.agent_rules) if args.agent_rules else (BROWSERS, SYSTEMS)


def _start_batches(
    spark: SparkSession, args: argparse.Namespace, trigger: Trigger
) -> list[StreamingQuery]:
    """The jobs that keep no state: counts of micro-batches, added up by the report."""
    table = SnapshotTable(args.report, JOBS[args.job][1], adds=True)
    if args.job == "logs":
        bounces, deliveries = (_topic(spark, args, topic) for topic in LOG_TOPICS.values())
        return start_log_batches(
            bounces, deliveries, table, args.archive, args.checkpoint, trigger
        )
    versions = args.lookup_versions
    if args.job == "user-agents":
        return start_agent_counts(
            _topic(spark, args, args.topic),
            followed_lookup(f"{versions}/{ISP_TABLE}"),
            AgentTexts(args.agent_texts, *_rules(args)),
            table,
            args.checkpoint,
            trigger,
        )
    return start_action_counts(
        _action_topics(spark, args),
        followed_lookup(f"{versions}/{ISP_TABLE}"),
        followed_lookup(f"{versions}/{LIST_TABLE}"),
        followed_blocks(f"{versions}/blocks"),
        table,
        args.checkpoint,
        trigger,
    )


def start(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    trigger = Trigger(args.every, args.once)
    if args.micro_batches:
        return _start_batches(spark, args, trigger)
    write = _writer(args, *JOBS[args.job])
    if args.job == "actions":
        topics = _action_topics(spark, args)
        networks = read_geo_blocks(spark, args.networks, args.places)
        networks6 = read_geo_blocks6(spark, args.networks, args.places)
        return start_actions(
            topics,
            _lookup(spark, args, ISP_TABLE),
            _lookup(spark, args, LIST_TABLE),
            geo_blocks(networks, blocks6=networks6),
            write,
            args.checkpoint,
            trigger,
        )
    if args.job == "logs":
        bounces, deliveries = (_topic(spark, args, topic) for topic in LOG_TOPICS.values())
        return start_logs(bounces, deliveries, write, args.archive, args.checkpoint, trigger)
    lines = _topic(spark, args, args.topic)
    isp_domains = _lookup(spark, args, ISP_TABLE)
    return start_user_agents(
        lines, isp_domains, args.checkpoint, write, trigger, args.console, *_rules(args)
    )


def check(options: argparse.ArgumentParser, args: argparse.Namespace) -> None:
    if args.micro_batches:
        if not args.report:
            options.error("--micro-batches needs --report")
        if args.job != "logs" and not args.lookup_versions:
            options.error(f"{args.job} with --micro-batches needs --lookup-versions")
        if args.job == "user-agents":
            if not args.agent_texts:
                options.error("user-agents with --micro-batches needs --agent-texts")
            if args.console:
                options.error("--console needs a job with state")
        if args.job != "logs":
            return
    if args.job == "actions" and not (args.networks and args.places):
        options.error("actions needs --networks and --places")
    if args.job == "logs" and not args.archive:
        options.error("logs needs --archive")


def main(argv: Sequence[str] | None = None) -> None:
    options = parser()
    args = options.parse_args(argv)
    check(options, args)
    spark = build_session(f"mailstream {args.job}")
    try:
        await_queries(start(spark, args))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
