"""Spark session and shared-folder settings."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Keyed counts never expire, so the state of a long-running job outgrows the
# heap: keep it in RocksDB and checkpoint only what changed.
STREAMING_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


ADAPTIVE = "spark.sql.adaptive.enabled"
CLOSING_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def build_session(
    app_name: str, master: str | None = None, **conf: str
) -> SparkSession:
    """A session with the settings the jobs rely on.

    Memory, cores and the master normally come from spark-submit; `conf` takes
    dotted names through `**{"spark.executor.memory": "10g"}`.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        **STREAMING_CONF,
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution for the jobs of one micro-batch; streams run without it."""
    before = spark.conf.get(ADAPTIVE)
    spark.conf.set(ADAPTIVE, "true")
    try:
        yield
    finally:
        spark.conf.set(ADAPTIVE, before)


@contextmanager
def closing_batches(spark: SparkSession, enabled: bool) -> Iterator[None]:
    """Whether streams that start meanwhile end with a micro-batch without rows.

    It closes what the last rows brought to an end; a stream that goes on later with more
    rows can leave that to its next micro-batch.
    """
    before = spark.conf.get(CLOSING_BATCHES)
    spark.conf.set(CLOSING_BATCHES, str(enabled).lower())
    try:
        yield
    finally:
        spark.conf.set(CLOSING_BATCHES, before)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder path that every executor can reach.

    It lies under `spark.checkpoint.dir`.  Only a local master, whose executors
    share the driver's disk, may go without that setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="mailstream-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
