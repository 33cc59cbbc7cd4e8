"""Every operator as a batch query over the whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailstream.catalog import fixtures as fx
from mailstream.functions.agents import FIELDS, unescape_commas
from mailstream.functions.bounce import HARD_BOUNCES, SOFT_BOUNCES, classify_bounce, in_list
from mailstream.functions.lines import email_domain, field_at, split_line, to_day
from mailstream.operators.agents import parse_user_agent, struct_expand
from mailstream.operators.decode import (
    action_fields,
    decode_actions,
    decode_bounces,
    decode_deliveries,
    log_fields,
)
from mailstream.operators.filters import drop_anonymous, drop_seeds
from mailstream.operators.geo import GeoBlocks, geo_blocks, ip_to_country
from mailstream.operators.lookup import Lookup, join_isp, join_lists, lookup_table
from mailstream.operators.rollup import rollup_all_columns, sum_counts, union_rows
from mailstream.plans.actions import action_rows, actions_rollup, enrich_actions
from mailstream.plans.logs import logs_rollup
from mailstream.plans.user_agents import user_agent_rollup


def isp_domains(spark: SparkSession, sf_dir: str) -> Lookup:
    return lookup_table(fx.isp_table(spark, sf_dir))


def lists(spark: SparkSession, sf_dir: str) -> Lookup:
    return lookup_table(fx.list_table(spark, sf_dir))


def blocks(spark: SparkSession, sf_dir: str) -> GeoBlocks:
    return geo_blocks(
        fx.nation_blocks(spark, sf_dir), blocks6=fx.nation_blocks6(spark, sf_dir)
    )


def _all_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_rows(*fx.action_lines(spark, sf_dir).values())


def _all_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_rows(*fx.log_lines(spark, sf_dir).values())


def _action_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return action_fields(_all_actions(spark, sf_dir))


def _log_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_fields(_all_logs(spark, sf_dir))


def _numbered_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _all_actions(spark, sf_dir)
    return lines.select("event_id", split_line("value").alias("fields"))


def q_split_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = _numbered_fields(spark, sf_dir)
    return fields.select(
        "event_id", F.size("fields").alias("n_fields"), F.concat_ws(";", "fields").alias("joined")
    )


def q_field_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = _numbered_fields(spark, sf_dir)
    return fields.select(
        "event_id", *(field_at("fields", at).alias(f"field_{at}") for at in range(15))
    )


def q_email_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log_fields(spark, sf_dir).select("rcpt", email_domain("rcpt").alias("email_domain"))


def q_compound_split_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log_fields(spark, sf_dir).select("job_id", "sub_id", "is_seed", "num", "user")


def q_compound_split_vmta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log_fields(spark, sf_dir).select("num", "domain", "ip")


def q_to_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = _numbered_fields(spark, sf_dir)
    return fields.select("event_id", to_day(field_at("fields", 5)).alias("date"))


def q_tag_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = action_rows(fx.action_lines(spark, sf_dir).items())
    return rows.select("job_id", "date", "vmta_id", "type")


def q_null_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_deliveries(fx.topic_lines(spark, sf_dir, "delivered"))


def q_classify_bounce(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = _log_fields(spark, sf_dir)
    return fields.select("num", "bounceCat", classify_bounce("bounceCat").alias("bounce_type"))


def q_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = _log_fields(spark, sf_dir)
    return fields.select(
        "num",
        in_list("bounceCat", HARD_BOUNCES).cast("int").alias("is_hard"),
        in_list("bounceCat", SOFT_BOUNCES).cast("int").alias("is_soft"),
    )


def q_prune_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = action_rows(fx.action_lines(spark, sf_dir).items())
    return enrich_actions(
        rows, isp_domains(spark, sf_dir), lists(spark, sf_dir), blocks(spark, sf_dir)
    )


def _agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User agents of all action lines, with the event they belong to."""
    fields = _numbered_fields(spark, sf_dir)
    return fields.select("event_id", field_at("fields", 8).alias("http_user_agent"))


def q_struct_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return struct_expand(parse_user_agent(_agents(spark, sf_dir))).drop("http_user_agent")


def q_unescape_commas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _agents(spark, sf_dir).select(
        "event_id", unescape_commas("http_user_agent").alias("user_agent")
    )


def q_device_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_user_agent(_agents(spark, sf_dir))
    return parsed.select("event_id", "user_agent.device_type")


def q_touch_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_user_agent(_agents(spark, sf_dir))
    return parsed.select("event_id", "user_agent.device_touch_capable")


def q_drop_anonymous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_anonymous(_action_fields(spark, sf_dir)).drop("http_user_agent")


def q_drop_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_seeds(_log_fields(spark, sf_dir))


def q_join_isp(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = _action_fields(spark, sf_dir).select("job_id", "date", "isp_id")
    return join_isp(fields, isp_domains(spark, sf_dir))


def q_join_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = _action_fields(spark, sf_dir).select("job_id", "date", "list_id")
    return join_lists(fields, lists(spark, sf_dir))


def q_ip_to_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = _action_fields(spark, sf_dir).select("job_id", "date", "request_ip")
    return ip_to_country(fields, blocks(spark, sf_dir))


def q_ip_to_country_many_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = _action_fields(spark, sf_dir).select("job_id", "date", "request_ip")
    return ip_to_country(fields, geo_blocks(fx.customer_blocks(spark, sf_dir)))


def q_parse_user_agent(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_user_agent(_agents(spark, sf_dir))
    return parsed.select("event_id", *(f"user_agent.{name}" for name in FIELDS))


def q_union_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return action_rows(fx.action_lines(spark, sf_dir).items())


def q_union_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fx.log_lines(spark, sf_dir)
    return union_rows(decode_bounces(lines["bounce"]), decode_deliveries(lines["delivered"]))


def q_rollup_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven keys, before names replace the ids."""
    return rollup_all_columns(action_rows(fx.action_lines(spark, sf_dir).items()))


def q_rollup_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each topic counted by itself, then the counts of both added up."""
    parts = [
        rollup_all_columns(q_union_logs(spark, sf_dir).where(F.col("type") == topic))
        for topic in fx.LOG_EVENTS
    ]
    return sum_counts(union_rows(*parts))


def q_rollup_user_agent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve keys over all three topics, the provider still as its id."""
    lines = fx.action_lines(spark, sf_dir)
    decoded = union_rows(*(decode_actions(part, topic) for topic, part in lines.items()))
    rows = rollup_all_columns(decoded.select("job_id", "date", "isp_id", "http_user_agent"))
    # Equal texts are counted first and parsed once.
    return sum_counts(struct_expand(parse_user_agent(rows)).drop("http_user_agent"))


def q_actions_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actions_rollup(
        fx.action_lines(spark, sf_dir).items(),
        isp_domains(spark, sf_dir),
        lists(spark, sf_dir),
        blocks(spark, sf_dir),
    )


def q_logs_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fx.log_lines(spark, sf_dir)
    return logs_rollup(lines["bounce"], lines["delivered"])


def q_user_agent_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_agent_rollup(
        fx.topic_lines(spark, sf_dir, "click"), isp_domains(spark, sf_dir)
    )


BATCH_QUERIES = {
    name.removeprefix("q_"): query
    for name, query in list(globals().items())
    if name.startswith("q_")
}
