"""Bounce and delivery counts per server, day, domain, job and sender address."""

from __future__ import annotations

from pyspark.sql import DataFrame

from mailstream.operators.decode import decode_bounces, decode_deliveries
from mailstream.operators.rollup import rollup_all_columns, union_rows


def logs_rollup(bounces: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Decode and count the raw lines of both topics."""
    return rollup_all_columns(
        union_rows(decode_bounces(bounces), decode_deliveries(deliveries))
    )
