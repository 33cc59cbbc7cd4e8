"""Static dimension tables read over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Driver class, dimension database and tables, result database and
# tables.
MYSQL_DRIVER = "com.mysql.cj.jdbc.Driver"
DIMENSION_DATABASE = "joins"
ISP_TABLE = "isp_domains"
LIST_TABLE = "lists"
RESULT_DATABASE = "streaming_data"
ACTIONS_TABLE = "actions_table"
LOGS_TABLE = "logs_table"
USER_AGENT_TABLE = "drive_stats"


@dataclass(frozen=True)
class JdbcTarget:
    """Where a database is and how to log in."""

    url: str
    user: str
    password: str = field(repr=False)
    driver: str = MYSQL_DRIVER

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
        }


def mysql_url(host: str, port: int, database: str) -> str:
    return f"jdbc:mysql://{host}:{port}/{database}"


def jdbc_dim_source(
    spark: SparkSession,
    target: JdbcTarget,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 16,
) -> DataFrame:
    """A whole dimension table.

    One connection reads it unless a numeric `partition_column` and its `bounds`
    are given; then `partitions` tasks read a slice each.
    """
    reader = spark.read.format("jdbc").options(**target.options()).option("dbtable", table)
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partitioned read needs the bounds of its column")
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return reader.load()
