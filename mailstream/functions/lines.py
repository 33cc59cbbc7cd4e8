"""Column expressions for the two comma-separated line formats.

A line has no header, quoting or escaping: the meaning of a field is its
position.  Everything here tolerates short and malformed lines under ANSI mode:
a field that is not there, or does not parse, is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Field positions of an action line (open, click, unsubscribe).
ACTION_FIELDS = {
    "job_id": 2,
    "rcpt_id": 3,
    "vmta_id": 4,
    "date": 5,
    "request_ip": 6,
    "http_user_agent": 8,
    "list_id": 11,
    "isp_id": 13,
}

# Field positions of a mail log line, and the pieces of its two
# compound fields.  Only bounce lines carry `bounceCat`.
LOG_FIELDS = {
    "server_name": 0,
    "date": 1,
    "rcpt": 3,
    "job": 4,
    "vmta": 5,
    "bounceCat": 6,
}
JOB_PIECES = ("job_id", "sub_id", "is_seed", "num", "user")
VMTA_PIECES = ("domain", "ip")


def split_line(value: Column | str) -> Column:
    """The fields of a line as an array; trailing empty fields are kept."""
    column = F.col(value) if isinstance(value, str) else value
    return F.split(column.cast("string"), ",")


def field_at(fields: Column | str, index: int) -> Column:
    """The field at a 0-based position, NULL when the line is too short."""
    return F.get(fields, F.lit(index))


def to_day(text: Column) -> Column:
    """DATE of a date or timestamp text, NULL when it does not parse."""
    return text.try_cast("date")


def email_domain(rcpt: Column | str) -> Column:
    """The piece after the first `@`, up to a second one if there is any."""
    return F.get(F.split(rcpt, "@"), F.lit(1))


def dash_pieces(text: Column | str) -> Column:
    """The pieces of a `-` joined compound field as an array."""
    return F.split(text, "-")
