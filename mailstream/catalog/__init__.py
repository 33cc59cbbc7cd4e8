"""Operators as named queries over the test tables, and their SQL."""

from mailstream.catalog.batch import BATCH_QUERIES
from mailstream.catalog.oracle import ORACLE_SQL
from mailstream.catalog.streams import STREAM_QUERIES

QUERIES = {**BATCH_QUERIES, **STREAM_QUERIES}

__all__ = ["ORACLE_SQL", "QUERIES"]
