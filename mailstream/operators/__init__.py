"""Steps from DataFrame to DataFrame, the same for batch and streaming input."""

from mailstream.operators.agents import parse_user_agent, struct_expand
from mailstream.operators.decode import (
    action_fields,
    decode_actions,
    decode_bounces,
    decode_deliveries,
    log_fields,
)
from mailstream.operators.filters import drop_anonymous, drop_seeds
from mailstream.operators.geo import geo_blocks, ip_to_country
from mailstream.operators.lookup import join_isp, join_lists, left_lookup, lookup_table
from mailstream.operators.rollup import rollup_all_columns, sum_counts, union_rows

__all__ = [
    "action_fields",
    "decode_actions",
    "decode_bounces",
    "decode_deliveries",
    "drop_anonymous",
    "drop_seeds",
    "geo_blocks",
    "ip_to_country",
    "join_isp",
    "join_lists",
    "left_lookup",
    "log_fields",
    "lookup_table",
    "parse_user_agent",
    "rollup_all_columns",
    "struct_expand",
    "sum_counts",
    "union_rows",
]
