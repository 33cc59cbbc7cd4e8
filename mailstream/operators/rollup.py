"""Union of decoded topics and counting per distinct row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOTAL = "total_count"
#: A row dated further ahead of the clock than this does not close earlier days.
AHEAD_DAYS = 1


def union_rows(*parts: DataFrame) -> DataFrame:
    """All rows of all parts, matched by column name."""
    return reduce(DataFrame.unionByName, parts)


def rollup_all_columns(rows: DataFrame) -> DataFrame:
    """Row count per combination of all columns; NULLs are one group.

    Each task counts its own rows before the shuffle, so a key that holds a third
    of the input arrives as one row per task.
    """
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias(TOTAL))


def sum_counts(counted: DataFrame) -> DataFrame:
    """Merge rows that became equal after counting, adding up their totals."""
    keys = [name for name in counted.columns if name != TOTAL]
    return counted.groupBy(*keys).agg(F.sum(TOTAL).alias(TOTAL))


def has_day(rows: DataFrame, day: str = "date") -> Column:
    """Whether a row can be counted by closed days: dated, and not far ahead of the clock.

    One row with a wrong date in the far future would close all days before it.
    """
    return F.coalesce(F.col(day) <= F.date_add(F.current_date(), AHEAD_DAYS), F.lit(False))


def closed_days_rollup(rows: DataFrame, delay: str, day: str = "date") -> DataFrame:
    """Row count per combination of all columns, for a stream that gives up closed days.

    A day is closed when a row is seen that is `delay` later than its end.  Then its counts
    are emitted, once, and its state is dropped; rows of closed days are late and are left
    out (`late_rows` counts them).  Rows without a day are not counted here.  Works in append
    mode; the state holds the keys of open days only.
    """
    time = F.col(day).cast("timestamp")
    dated = rows.where(has_day(rows, day)).withColumn("__time", time)
    window = F.window("__time", "1 day")
    counted = dated.withWatermark("__time", delay).groupBy(window, *rows.columns)
    return counted.agg(F.count(F.lit(1)).alias(TOTAL)).drop("window")
