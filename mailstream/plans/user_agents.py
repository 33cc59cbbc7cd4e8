"""Click counts per job, day, provider and the nine user-agent fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from mailstream.functions.agents import BROWSERS, FIELDS, SYSTEMS, Rule
from mailstream.operators.agents import parse_user_agent, struct_expand
from mailstream.operators.decode import decode_actions
from mailstream.operators.lookup import HotKeys, Lookup, join_isp
from mailstream.operators.rollup import TOTAL, rollup_all_columns, sum_counts

USER_AGENT_KEYS = ("job_id", "date", "domain_name", *FIELDS)


def agent_rows(lines: DataFrame) -> DataFrame:
    """Decoded rows with what the report needs."""
    decoded = decode_actions(lines, "click")
    return decoded.select("job_id", "date", "isp_id", "http_user_agent")


def enrich_agents(
    rows: DataFrame,
    isp_domains: Lookup,
    browsers: Sequence[Rule] = BROWSERS,
    systems: Sequence[Rule] = SYSTEMS,
) -> DataFrame:
    """Provider names and parsed user agents; a total is kept."""
    agents = parse_user_agent(rows, browsers=browsers, systems=systems)
    return name_providers(struct_expand(agents), isp_domains)


def name_providers(
    rows: DataFrame, isp_domains: Lookup, hot: HotKeys | None = None
) -> DataFrame:
    """The columns of the report from parsed rows; a total is kept."""
    others = [name for name in rows.columns if name == TOTAL]
    return join_isp(rows, isp_domains, hot).select(*USER_AGENT_KEYS, *others)


def user_agent_rollup(
    lines: DataFrame,
    isp_domains: Lookup,
    browsers: Sequence[Rule] = BROWSERS,
    systems: Sequence[Rule] = SYSTEMS,
) -> DataFrame:
    """Decode, parse and count; the same for batch and streaming input.

    A batch counts equal raw rows first and parses one text per group.  A stream
    parses each row: a second count would need a second state.
    """
    rows = agent_rows(lines)
    if rows.isStreaming:
        return rollup_all_columns(enrich_agents(rows, isp_domains, browsers, systems))
    return sum_counts(enrich_agents(rollup_all_columns(rows), isp_domains, browsers, systems))
