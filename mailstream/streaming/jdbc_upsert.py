"""Keyed upsert into a MySQL table, written by the executors.

The batch goes to a staging table over a few parallel connections; two statements
on the server then replace the totals of known keys and insert the new ones.  Keys
are compared with `<=>`, so a NULL in a key matches a NULL, and texts by their bytes,
so that keys which differ by letter case only stay apart.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from mailstream.operators.rollup import TOTAL
from mailstream.sources.jdbc import JdbcTarget

#: Compares texts by their bytes.
BINARY = "utf8mb4_bin"
TEXT_TYPE = "VARCHAR(512)"
QUERY_ID = "sql.streaming.queryId"

Execute = Callable[[SparkSession, JdbcTarget, Sequence[str]], None]


def _quoted(name: str) -> str:
    return f"`{name}`"


def merge_statements(
    table: str, staging: str, keys: Sequence[str], texts: Sequence[str] = ()
) -> list[str]:
    """Update, then insert; `texts` are the keys that are compared byte by byte.

    A retried task may have staged a row twice with the same total, so the staging
    table is read grouped by key."""

    def exact(owner: str, key: str) -> str:
        name = f"{owner}{_quoted(key)}"
        return f"{name} COLLATE {BINARY}" if key in texts else name

    grouped = ", ".join(exact("", key) for key in keys)
    selected = ", ".join(
        f"{exact('', key)} AS {_quoted(key)}" if key in texts else _quoted(key) for key in keys
    )
    columns = ", ".join(map(_quoted, keys))
    total = _quoted(TOTAL)
    staged = (
        f"(SELECT {selected}, MAX({total}) AS {total} FROM {_quoted(staging)} "
        f"GROUP BY {grouped}) AS s"
    )
    same = " AND ".join(f"{exact('t.', key)} <=> s.{_quoted(key)}" for key in keys)
    picked = ", ".join(f"s.{_quoted(key)}" for key in keys)
    return [
        f"UPDATE {_quoted(table)} AS t JOIN {staged} ON {same} SET t.{total} = s.{total}",
        f"INSERT INTO {_quoted(table)} ({columns}, {total}) SELECT {picked}, s.{total} "
        f"FROM {staged} LEFT JOIN {_quoted(table)} AS t ON {same} WHERE t.{total} IS NULL",
    ]


def run_statements(
    spark: SparkSession, target: JdbcTarget, statements: Sequence[str]
) -> None:
    """Run statements in one transaction over the driver's JDBC connection."""
    jvm = spark._jvm
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    driver = loader.loadClass(target.driver).getDeclaredConstructor().newInstance()
    login = jvm.java.util.Properties()
    login.setProperty("user", target.user)
    login.setProperty("password", target.password)
    connection = driver.connect(target.url, login)
    try:
        connection.setAutoCommit(False)
        for text in statements:
            statement = connection.createStatement()
            statement.executeUpdate(text)
            statement.close()
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def upsert_jdbc(
    batch: DataFrame,
    target: JdbcTarget,
    table: str,
    connections: int = 16,
    execute: Execute = run_statements,
    text_type: str = TEXT_TYPE,
) -> None:
    """Replace the totals of the batch's keys in `table`.

    `text_type` is the type of text keys in the staging table; an index can serve it.

    An error is raised, so the micro-batch is retried from its checkpoint; running
    totals make the retry harmless.
    """
    spark = batch.sparkSession
    # Two jobs on one table stage their rows apart.
    query_id = spark.sparkContext.getLocalProperty(QUERY_ID) or ""
    staging = "_".join(filter(None, [table, "staging", query_id.replace("-", "")[:12]]))
    keys = [name for name in batch.columns if name != TOTAL]
    texts = [name for name, kind in batch.dtypes if kind == "string"]
    types = ", ".join(f"{_quoted(name)} {text_type}" for name in texts)
    (
        batch.write.format("jdbc")
        .options(**target.options())
        .option("dbtable", staging)
        .option("truncate", "true")
        .option("numPartitions", str(connections))
        .option("batchsize", "10000")
        .options(**({"createTableColumnTypes": types} if types else {}))
        .mode("overwrite")
        .save()
    )
    execute(spark, target, merge_statements(table, staging, keys, texts))
