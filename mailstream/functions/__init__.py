"""Column expressions: no DataFrame, no session, no Python at run time."""

from mailstream.functions.agents import device_type, touch_flag, unescape_commas
from mailstream.functions.bounce import classify_bounce, in_list
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

__all__ = [
    "ACTION_FIELDS",
    "JOB_PIECES",
    "LOG_FIELDS",
    "VMTA_PIECES",
    "classify_bounce",
    "dash_pieces",
    "device_type",
    "email_domain",
    "field_at",
    "in_list",
    "split_line",
    "to_day",
    "touch_flag",
    "unescape_commas",
]
