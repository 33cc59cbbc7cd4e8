"""The same queries as SQL on the same tables, written independently.

Only the recipe that makes the wire lines is shared.  User agents are checked
against hand-written expected values, addresses against a plain range join.
"""

from __future__ import annotations

from mailstream.catalog.agent_cases import AGENT_CASES, MISSING_AGENT
from mailstream.catalog.fixtures import (
    ACTION_EVENTS,
    LOG_EVENTS,
    line_sql,
    topic_event,
)


def _lines(topics: dict[str, str]) -> str:
    """`lines(event_id, topic, value)` over all events of some topics."""
    parts = (
        f"select event_id, '{topic}' as topic, {line_sql(topic, 'varchar')} as value "
        f"from events where event_type = '{topic_event(topic)}'"
        for topic in topics
    )
    return "lines as (" + " union all ".join(parts) + ")"


_ACTION_FIELDS = """
fields as (select event_id, topic, string_split(value, ',') as f from lines),
decoded as (select event_id, topic as type, f[3] as job_id, f[4] as rcpt_id, f[5] as vmta_id,
  try_cast(f[6] as date) as date, f[7] as request_ip, f[9] as http_user_agent,
  f[12] as list_id, f[14] as isp_id from fields)"""

_LOG_FIELDS = """
fields as (select topic, string_split(value, ',') as f from lines),
pieces as (select topic, f, string_split(f[5], '-') as job, string_split(f[6], '-') as vmta
  from fields),
decoded as (select topic as type, f[1] as server_name, try_cast(f[2] as date) as date,
  f[4] as rcpt, string_split(f[4], '@')[2] as email_domain, job[1] as job_id, job[2] as sub_id,
  job[3] as is_seed, job[4] as num, job[5] as "user", vmta[1] as domain, vmta[2] as ip,
  f[7] as "bounceCat" from pieces)"""

_BOUNCE_TYPE = """case when "bounceCat" in ('bad-mailbox', 'inactive-mailbox') then 'hard'
  when "bounceCat" in ('policy-related', 'quota-issues') then 'soft' else 'other' end"""

_LOG_ROWS = f"""
rows as (select server_name, date, email_domain, job_id, "user", domain, ip, type,
  case when type = 'bounce' then {_BOUNCE_TYPE} end as bounce_type
  from decoded where try_cast(is_seed as integer) = 0)"""

# An address that stands for an IPv4 address ends with it.
_IPV4 = "regexp_replace(request_ip, '^::ffff:', '')"
_OCTETS = [f"try_cast(split_part({_IPV4}, '.', {n}) as bigint)" for n in (1, 2, 3, 4)]
_ADDRESSES = f"""
addresses as (select *, case when
    regexp_full_match({_IPV4}, '([0-9]{{1,3}}\\.){{3}}[0-9]{{1,3}}')
    and greatest({', '.join(_OCTETS)}) < 256
  then ({_OCTETS[0]} * 16777216 + {_OCTETS[1]} * 65536 + {_OCTETS[2]} * 256 + {_OCTETS[3]})
  end as address,
  case when regexp_full_match(request_ip, '2001:db8:[0-9a-f]+::[0-9a-f]+')
    or regexp_full_match(request_ip, '2001:0DB8:[0-9A-F]+:[78][0-9A-F]+(:[0-9A-F]+){{4}}')
  then cast('0x' || split_part(request_ip, ':', 3) as bigint) end as net6,
  split_part(request_ip, ':', 4) = '8000' as upper6 from decoded)"""

_NATION_BLOCKS6 = """
blocks6 as (select id, id % 9 = 1 as lower_only, n_name as country6
  from (select range as id from range(256)) join nation
  on n_nationkey = id % 25 where id % 9 <> 0)"""
_JOIN6 = "left join blocks6 on net6 = id and not (lower_only and upper6)"

_NATION_BLOCKS = """
blocks as (select id * 16777216 + 1000 as lo, id * 16777216 + 1000 + 8388608 + 12345 as hi,
  n_name as country from (select range as id from range(256)) join nation
  on n_nationkey = id % 25 where id % 9 <> 0)"""

_CUSTOMER_BLOCKS = """
stride as (select 4294967296 // (max(c_custkey) + 1) as size from customer),
blocks as (select c_custkey * size as lo, c_custkey * size + size - 301 as hi,
  n_name as country from customer cross join stride
  join nation on c_nationkey = n_nationkey)"""

def _literal(value: str | int | None) -> str:
    if value is None:
        return "null"
    return str(value) if isinstance(value, int) else f"'{value}'"


def _agent_table() -> str:
    rows = (*AGENT_CASES, (None, MISSING_AGENT))
    values = ", ".join(
        "(" + ", ".join(_literal(value) for value in (text, *fields)) + ")"
        for text, fields in rows
    )
    return f"""
agents as (select * from (values {values}) as t(text, browser_family, browser_version,
  os_family, os_version, device_family, device_brand, device_model, device_type,
  device_touch_capable)),
parsed as (select decoded.*, agents.* exclude (text) from decoded left join agents
  on decoded.http_user_agent is not distinct from agents.text)"""


_AGENT_COLUMNS = (
    "browser_family, browser_version, os_family, os_version, device_family, device_brand, "
    "device_model, device_type, device_touch_capable"
)
_ACTIONS = f"with {_lines(ACTION_EVENTS)}, {_ACTION_FIELDS}"
_LOGS = f"with {_lines(LOG_EVENTS)}, {_LOG_FIELDS}"
_AGENTS = f"{_ACTIONS}, {_agent_table()}"
_KNOWN = "where rcpt_id <> '0'"
_ACTION_ROWS = "job_id, date, vmta_id, request_ip, list_id, isp_id, type"

_ENRICHED = f"""{_ACTIONS}, {_ADDRESSES}, {_NATION_BLOCKS}, {_NATION_BLOCKS6},
enriched as (select job_id, date, vmta_id, coalesce(country, country6) as country, d.n_name as domain_name,
  s.s_name as list_name, type from addresses
  left join blocks on address between lo and hi
  {_JOIN6}
  left join nation d on try_cast(isp_id as bigint) = d.n_nationkey
  left join supplier s on try_cast(list_id as bigint) = s.s_suppkey {_KNOWN})"""

_ACTIONS_ROLLUP = f"{_ENRICHED} select *, count(*) as total_count from enriched group by all"
_LOGS_ROLLUP = f"{_LOGS}, {_LOG_ROWS} select *, count(*) as total_count from rows group by all"
_AGENT_ROLLUP = f"""{_AGENTS} select job_id, date, n_name as domain_name, {_AGENT_COLUMNS},
  count(*) as total_count from parsed left join nation
  on try_cast(isp_id as bigint) = n_nationkey {_KNOWN} and type = 'click' group by all"""
_COUNTRY = """select job_id, date, request_ip, country from addresses
  left join blocks on address between lo and hi"""

ORACLE_SQL: dict[str, str] = {
    "split_line": f"""with {_lines(ACTION_EVENTS)} select event_id,
      cast(length(value) - length(replace(value, ',', '')) + 1 as integer) as n_fields,
      replace(value, ',', ';') as joined from lines""",
    "field_at": f"""{_ACTIONS} select event_id,
      {', '.join(f'f[{at + 1}] as field_{at}' for at in range(15))} from fields""",
    "email_domain": f"{_LOGS} select rcpt, email_domain from decoded",
    "compound_split_job": f'{_LOGS} select job_id, sub_id, is_seed, num, "user" from decoded',
    "compound_split_vmta": f"{_LOGS} select num, domain, ip from decoded",
    "to_day": f"{_ACTIONS} select event_id, date from decoded",
    "tag_type": f"{_ACTIONS} select job_id, date, vmta_id, type from decoded {_KNOWN}",
    "null_column": f"{_LOGS}, {_LOG_ROWS} select * from rows where type = 'delivered'",
    "classify_bounce": f"""{_LOGS} select num, "bounceCat", {_BOUNCE_TYPE} as bounce_type
      from decoded""",
    "in_list": f"""{_LOGS} select num,
      cast("bounceCat" in ('bad-mailbox', 'inactive-mailbox') as integer) as is_hard,
      cast("bounceCat" in ('policy-related', 'quota-issues') as integer) as is_soft
      from decoded""",
    "prune_rename": f"{_ENRICHED} select * from enriched",
    "struct_expand": f"{_AGENTS} select event_id, {_AGENT_COLUMNS} from parsed",
    "unescape_commas": f"""{_ACTIONS} select event_id,
      replace(http_user_agent, '|||', ',') as user_agent from decoded""",
    "device_type": f"{_AGENTS} select event_id, device_type from parsed",
    "touch_flag": f"{_AGENTS} select event_id, device_touch_capable from parsed",
    "drop_anonymous": f"""{_ACTIONS} select job_id, rcpt_id, vmta_id, date, request_ip,
      list_id, isp_id from decoded {_KNOWN}""",
    "drop_seeds": f"""{_LOGS} select * exclude (type) from decoded
      where try_cast(is_seed as integer) = 0""",
    "join_isp": f"""{_ACTIONS} select job_id, date, isp_id, n_name as domain_name
      from decoded left join nation on try_cast(isp_id as bigint) = n_nationkey""",
    "join_lists": f"""{_ACTIONS} select job_id, date, list_id, s_name as list_name
      from decoded left join supplier on try_cast(list_id as bigint) = s_suppkey""",
    "ip_to_country": f"""{_ACTIONS}, {_ADDRESSES}, {_NATION_BLOCKS}, {_NATION_BLOCKS6}
      select job_id, date, request_ip, coalesce(country, country6) as country from addresses
      left join blocks on address between lo and hi {_JOIN6}""",
    "ip_to_country_many_blocks": f"{_ACTIONS}, {_ADDRESSES}, {_CUSTOMER_BLOCKS} {_COUNTRY}",
    "parse_user_agent": f"{_AGENTS} select event_id, {_AGENT_COLUMNS} from parsed",
    "union_actions": f"{_ACTIONS} select {_ACTION_ROWS} from decoded {_KNOWN}",
    "union_logs": f"{_LOGS}, {_LOG_ROWS} select * from rows",
    "rollup_actions": f"""{_ACTIONS} select {_ACTION_ROWS}, count(*) as total_count
      from decoded {_KNOWN} group by all""",
    "rollup_logs": _LOGS_ROLLUP,
    "rollup_user_agent": f"""{_AGENTS} select job_id, date, isp_id, {_AGENT_COLUMNS},
      count(*) as total_count from parsed {_KNOWN} group by all""",
    "actions_rollup": _ACTIONS_ROLLUP,
    "logs_rollup": _LOGS_ROLLUP,
    "logs_archive": f"{_LOGS}, {_LOG_ROWS} select * from rows",
    "logs_backfill": f"{_LOGS}, {_LOG_ROWS} select * from rows",
    "user_agent_rollup": _AGENT_ROLLUP,
    "stream_actions_rollup": _ACTIONS_ROLLUP,
    "stream_logs_batches": _LOGS_ROLLUP,
    "logs_archive_batches": f"{_LOGS}, {_LOG_ROWS} select * from rows",
    "stream_actions_versioned": _ACTIONS_ROLLUP,
    "stream_logs_closed_days": f"""{_LOGS}, {_LOG_ROWS}, last as (select max(date) as day from rows)
      select rows.*, count(*) as total_count from rows join last on rows.date <= last.day - 2
      group by all""",
    "stream_logs_rollup": _LOGS_ROLLUP,
    "stream_logs_compacted": _LOGS_ROLLUP,
    "stream_user_agent_rollup": _AGENT_ROLLUP,
    "stream_user_agent_texts": _AGENT_ROLLUP,
    "upsert_snapshot": _LOGS_ROLLUP,
}
