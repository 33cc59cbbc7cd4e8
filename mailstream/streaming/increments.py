"""Counts by micro-batch, added up by the result table instead of a stream's state.

A micro-batch is decoded, counted, enriched and counted again as a batch job of its own; its
counts are published under its number, and reading or compacting the table adds them up.  So
nothing is kept between micro-batches but the table: keys need no state store, each
micro-batch may use other versions of the lookup tables and so other join strategies, hot
keys are measured in it, and adaptive execution is on.  A replayed micro-batch that was
published is skipped, one that was not is done anew with the versions of that moment.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mailstream.operators.decode import decode_bounces, decode_deliveries
from mailstream.operators.geo import GeoBlocks
from mailstream.operators.lookup import Lookup, hot_keys, left_join_static, lookup_key
from mailstream.operators.rollup import rollup_all_columns, sum_counts, union_rows
from mailstream.plans.actions import action_rows, enrich_actions, hot_action_keys
from mailstream.plans.schemas import LOG_ARCHIVE
from mailstream.plans.user_agents import agent_rows, name_providers
from mailstream.session import adaptive
from mailstream.sources.versions import Followed
from mailstream.streaming.agent_texts import AGENT, AgentTexts, fields_of
from mailstream.streaming.archive import archive_batch, merge_runs
from mailstream.streaming.sinks import COMPACT_EVERY, Trigger
from mailstream.streaming.snapshot import SnapshotTable, compact, expire, is_published, publish

#: What a micro-batch counts, and the version of each lookup table it used.
Counted = tuple[DataFrame, dict[str, int]]


def _publish_and_compact(
    result: DataFrame,
    batch_id: int,
    table: SnapshotTable,
    versions: dict[str, int] | None,
    compact_every: int,
) -> None:
    publish(result, batch_id, table, versions)
    if batch_id % compact_every == compact_every - 1:
        compact(result.sparkSession, table)
        expire(result.sparkSession, table)


def _check_adds(table: SnapshotTable) -> None:
    if not table.adds:
        raise ValueError("counts of micro-batches need a table that adds them up")


def start_increments(
    rows: DataFrame,
    count: Callable[[DataFrame], Counted],
    table: SnapshotTable,
    checkpoint: str,
    trigger: Trigger = Trigger(),
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Publish what `count` makes of each micro-batch of `rows`; the table must add up."""
    _check_adds(table)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if is_published(spark, table, batch_id):
            return
        # Equal rows become one before anything else is done with them.
        counted = rollup_all_columns(batch).persist()
        try:
            with adaptive(spark):
                result, versions = count(counted)
                _publish_and_compact(result, batch_id, table, versions, compact_every)
        finally:
            counted.unpersist()

    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return trigger.apply(writer).start()


def start_action_counts(
    topics: Iterable[tuple[str, DataFrame]],
    isp_domains: Followed[Lookup],
    lists: Followed[Lookup],
    blocks: Followed[GeoBlocks],
    table: SnapshotTable,
    checkpoint: str,
    trigger: Trigger = Trigger(),
    compact_every: int = COMPACT_EVERY,
) -> list[StreamingQuery]:
    """Counts of opens, clicks and unsubscribes with lookup tables that may change.

    A row gets the names of the versions that are newest when its micro-batch runs;
    `batch_versions` tells which.
    """
    followed = {"isp_domains": isp_domains, "lists": lists, "blocks": blocks}

    def count(counted: DataFrame) -> Counted:
        spark = counted.sparkSession
        found = {name: table.current(spark) for name, table in followed.items()}
        tables = [value for _, value in found.values()]
        hot = hot_action_keys(counted, *tables)
        named = sum_counts(enrich_actions(counted, *tables, hot))
        return named, {name: version for name, (version, _) in found.items()}

    rows = action_rows(topics)
    path = f"{checkpoint}/action_counts"
    return [start_increments(rows, count, table, path, trigger, compact_every)]


def start_agent_counts(
    lines: DataFrame,
    isp_domains: Followed[Lookup],
    texts: AgentTexts,
    table: SnapshotTable,
    checkpoint: str,
    trigger: Trigger = Trigger(),
    compact_every: int = COMPACT_EVERY,
) -> list[StreamingQuery]:
    """Counts per device, with a provider table that may change and texts parsed once.

    Rows are counted before their texts are looked up.  Where the fields of a micro-batch's
    texts are too large to broadcast, hot texts and providers are measured and salted.
    """

    def count(counted: DataFrame) -> Counted:
        spark = counted.sparkSession
        version, isps = isp_domains.current(spark)
        fields = fields_of(counted, texts)
        keys = {}
        if not fields.small:
            keys[AGENT] = F.col(AGENT)
        if not isps.small:
            keys["isp_id"] = lookup_key(isps, "isp_id")
        hot = hot_keys(counted, keys, int(spark.conf.get("spark.sql.shuffle.partitions")))
        # A row without a text needs no dictionary.
        texted, textless = (counted.where(c) for c in (f"{AGENT} is not null", f"{AGENT} is null"))
        found = fields.table.withColumnRenamed(AGENT, "__text")
        parsed = left_join_static(
            texted, found, F.col(AGENT), "__text", fields.small, salts=hot.get(AGENT)
        )
        rows = parsed.drop("__text").unionByName(texts.parse(textless))
        return sum_counts(name_providers(rows, isps, hot)), {"isp_domains": version}

    path = f"{checkpoint}/agent_counts"
    return [start_increments(agent_rows(lines), count, table, path, trigger, compact_every)]


def start_log_batches(
    bounces: DataFrame,
    deliveries: DataFrame,
    table: SnapshotTable,
    archive: str,
    checkpoint: str,
    trigger: Trigger = Trigger(),
    compact_every: int = COMPACT_EVERY,
) -> list[StreamingQuery]:
    """Counts of both topics and an archive of each, from one reading of each topic.

    A micro-batch goes to the archives first, under its number, and counts as done when its
    counts are published.  If it fails in between, the replay finds what is archived, writes
    the rest, and publishes: nothing is lost or doubled.
    """
    _check_adds(table)
    folders = {"bounce": f"{archive}/bounced", "delivered": f"{archive}/delivered"}

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if is_published(spark, table, batch_id):
            return
        rows = batch.persist()
        try:
            with adaptive(spark):
                for label, folder in folders.items():
                    archive_batch(rows.where(F.col("type") == label), batch_id, folder)
                counts = rollup_all_columns(rows)
                _publish_and_compact(counts, batch_id, table, None, compact_every)
                for folder in folders.values():
                    merge_runs(spark, batch_id, folder, LOG_ARCHIVE)
        finally:
            rows.unpersist()

    rows = union_rows(decode_bounces(bounces), decode_deliveries(deliveries))
    path = f"{checkpoint}/log_batches"
    writer = rows.writeStream.option("checkpointLocation", path).foreachBatch(write)
    return [trigger.apply(writer).start()]
