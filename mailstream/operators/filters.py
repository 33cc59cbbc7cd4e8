"""Row filters on decoded lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_anonymous(rows: DataFrame) -> DataFrame:
    """Keep rows with a known recipient: `rcpt_id` is neither `0` nor missing."""
    return rows.where(F.col("rcpt_id") != "0")


def drop_seeds(rows: DataFrame) -> DataFrame:
    """Keep rows whose seed flag is the number 0; test mailboxes carry 1.

    The flag is compared as a number, so `00` passes; text that is no number is
    dropped.
    """
    return rows.where(F.col("is_seed").try_cast("int") == 0)
