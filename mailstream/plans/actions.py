"""Open, click and unsubscribe counts per job, day, country, provider and list."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from mailstream.operators.decode import decode_actions
from mailstream.operators.geo import (
    GeoBlocks,
    address_numbers,
    ip_to_country,
    shuffled_networks,
)
from mailstream.operators.lookup import (
    HotKeys,
    Lookup,
    hot_keys,
    join_isp,
    join_lists,
    lookup_key,
)
from mailstream.operators.rollup import (
    TOTAL,
    rollup_all_columns,
    sum_counts,
    union_rows,
)

ACTION_KEYS = (
    "job_id",
    "date",
    "vmta_id",
    "country",
    "domain_name",
    "list_name",
    "type",
)


def action_rows(topics: Iterable[tuple[str, DataFrame]]) -> DataFrame:
    """Decoded rows of several topics, given as (label, lines); labels may repeat."""
    decoded = (decode_actions(lines, label) for label, lines in topics)
    return union_rows(*decoded).drop("http_user_agent")


def enrich_actions(
    rows: DataFrame,
    isp_domains: Lookup,
    lists: Lookup,
    blocks: GeoBlocks,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Ids and addresses replaced by names; further columns are kept."""
    others = [name for name in rows.columns if name == TOTAL]
    named = join_isp(ip_to_country(rows, blocks, hot=hot), isp_domains, hot)
    return join_lists(named, lists, hot).select(*ACTION_KEYS, *others)


def hot_action_keys(
    rows: DataFrame, isp_domains: Lookup, lists: Lookup, blocks: GeoBlocks
) -> HotKeys:
    """Hot keys of `rows` in the joins that need a shuffle; no job where none does."""
    lookups = {"isp_id": isp_domains, "list_id": lists}
    keys = {name: lookup_key(table, name) for name, table in lookups.items() if not table.small}
    keys |= shuffled_networks(blocks)
    pieces = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return hot_keys(address_numbers(rows), keys, pieces) if keys else {}


def actions_rollup(
    topics: Iterable[tuple[str, DataFrame]],
    isp_domains: Lookup,
    lists: Lookup,
    blocks: GeoBlocks,
) -> DataFrame:
    """Decode, enrich and count; the same for batch and streaming input.

    With small lookups the only shuffle is that of the final count.  If one has to be
    shuffled, a batch counts the raw rows first, so copies are not shuffled again by each
    join.  A stream whose state counts the result cannot do that; `start_action_counts`
    counts micro-batches instead.
    """
    rows = action_rows(topics)
    small = isp_domains.small and lists.small and blocks.all_small
    if small or rows.isStreaming:
        return rollup_all_columns(enrich_actions(rows, isp_domains, lists, blocks))
    counted = rollup_all_columns(rows)
    return sum_counts(enrich_actions(counted, isp_domains, lists, blocks))
