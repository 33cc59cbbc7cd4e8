"""Where lines, lookup tables and address blocks come from."""

from mailstream.sources.files import file_lines, file_source
from mailstream.sources.geo import (
    cidr_blocks,
    cidr_blocks6,
    read_geo_blocks,
    read_geo_blocks6,
)
from mailstream.sources.jdbc import JdbcTarget, jdbc_dim_source, mysql_url
from mailstream.sources.kafka import ACTION_TOPICS, LOG_TOPICS, kafka_source

__all__ = [
    "ACTION_TOPICS",
    "LOG_TOPICS",
    "JdbcTarget",
    "cidr_blocks",
    "cidr_blocks6",
    "file_lines",
    "file_source",
    "jdbc_dim_source",
    "kafka_source",
    "mysql_url",
    "read_geo_blocks",
    "read_geo_blocks6",
]
