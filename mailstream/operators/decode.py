"""From raw lines to the columns each job works with.

The filter column is projected together with the rest and dropped by the final
select, after the filter has used it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailstream.functions.bounce import classify_bounce
from mailstream.functions.lines import (
    ACTION_FIELDS,
    JOB_PIECES,
    LOG_FIELDS,
    VMTA_PIECES,
    dash_pieces,
    email_domain,
    field_at,
    split_line,
    to_day,
)
from mailstream.operators.filters import drop_anonymous, drop_seeds

ACTION_COLUMNS = (
    "job_id",
    "date",
    "vmta_id",
    "request_ip",
    "http_user_agent",
    "list_id",
    "isp_id",
)
LOG_COLUMNS = (
    "server_name",
    "date",
    "email_domain",
    "job_id",
    "user",
    "domain",
    "ip",
    "type",
    "bounce_type",
)


def action_fields(lines: DataFrame) -> DataFrame:
    """Every named field of action lines, one column each."""
    parts = lines.select(split_line("value").alias("fields"))
    columns = {name: field_at("fields", at) for name, at in ACTION_FIELDS.items()}
    columns["date"] = to_day(columns["date"])
    return parts.select(*(column.alias(name) for name, column in columns.items()))


def decode_actions(lines: DataFrame, label: str) -> DataFrame:
    """Rows of one action topic with a known recipient, tagged with `label`."""
    return drop_anonymous(action_fields(lines)).select(
        *ACTION_COLUMNS, F.lit(label).alias("type")
    )


def log_fields(lines: DataFrame) -> DataFrame:
    """Every named field of mail log lines, compound fields taken apart."""
    parts = lines.select(split_line("value").alias("fields"))
    pieces = parts.select(
        field_at("fields", LOG_FIELDS["server_name"]).alias("server_name"),
        to_day(field_at("fields", LOG_FIELDS["date"])).alias("date"),
        field_at("fields", LOG_FIELDS["rcpt"]).alias("rcpt"),
        dash_pieces(field_at("fields", LOG_FIELDS["job"])).alias("job"),
        dash_pieces(field_at("fields", LOG_FIELDS["vmta"])).alias("vmta"),
        field_at("fields", LOG_FIELDS["bounceCat"]).alias("bounceCat"),
    )
    return pieces.select(
        "server_name",
        "date",
        "rcpt",
        email_domain("rcpt").alias("email_domain"),
        *(field_at("job", at).alias(name) for at, name in enumerate(JOB_PIECES)),
        *(field_at("vmta", at).alias(name) for at, name in enumerate(VMTA_PIECES)),
        "bounceCat",
    )


def _decode_logs(lines: DataFrame, label: str, bounce_type: Column) -> DataFrame:
    tagged = drop_seeds(log_fields(lines)).withColumns(
        {"type": F.lit(label), "bounce_type": bounce_type}
    )
    return tagged.select(*LOG_COLUMNS)


def decode_bounces(lines: DataFrame) -> DataFrame:
    """Bounce rows without seeds, classified."""
    return _decode_logs(lines, "bounce", classify_bounce("bounceCat"))


def decode_deliveries(lines: DataFrame) -> DataFrame:
    """Delivery rows without seeds; their `bounce_type` is a typed NULL."""
    return _decode_logs(lines, "delivered", F.lit(None).cast("string"))
