"""Columns of the three reports and of the log archive."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from mailstream.operators.decode import LOG_COLUMNS
from mailstream.operators.rollup import TOTAL
from mailstream.plans.actions import ACTION_KEYS
from mailstream.plans.user_agents import USER_AGENT_KEYS

NOT_TEXT = {"date": DateType(), "device_touch_capable": IntegerType(), TOTAL: LongType()}


def _schema(*names: str) -> StructType:
    return StructType([StructField(name, NOT_TEXT.get(name, StringType())) for name in names])


ACTIONS_REPORT = _schema(*ACTION_KEYS, TOTAL)
LOGS_REPORT = _schema(*LOG_COLUMNS, TOTAL)
USER_AGENT_REPORT = _schema(*USER_AGENT_KEYS, TOTAL)
LOG_ARCHIVE = _schema(*LOG_COLUMNS)
