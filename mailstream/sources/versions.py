"""Lookup tables as numbered versions that a running stream follows.

A version is a folder `version=<n>` that is complete once its `_SUCCESS` file is there, and
never changes afterwards.  Whoever maintains a table publishes versions; each micro-batch
asks for the newest one, and what was built from the version before (checked keys, measured
size, cut blocks) is built anew only when there is another.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Generic, TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailstream.operators.geo import GeoBlocks, geo_blocks, stored_blocks
from mailstream.operators.lookup import BROADCAST_BYTES, Lookup, lookup_table

T = TypeVar("T")


def version_folder(path: str, version: int) -> str:
    return f"{path}/version={version}"


def latest_version(spark: SparkSession, path: str) -> int | None:
    """Number of the newest complete version."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version=*/_SUCCESS")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.globStatus(pattern) or []
    return max((int(f.getPath().getParent().getName().split("=")[1]) for f in found), default=None)


def _next(spark: SparkSession, path: str) -> int:
    newest = latest_version(spark, path)
    return 0 if newest is None else newest + 1


def publish_version(table: DataFrame, path: str) -> int:
    """Write a table as the next version.  Of two writers at once one fails."""
    version = _next(table.sparkSession, path)
    table.write.mode("errorifexists").parquet(version_folder(path, version))
    return version


def _content(table: DataFrame) -> tuple:
    """Row count and order-free checksum of all values."""
    row = F.xxhash64(*table.columns).cast("decimal(38,0)")
    return tuple(table.agg(F.count(F.lit(1)), F.sum(row)).first())


def refresh_version(table: DataFrame, path: str) -> int:
    """Publish a table, a database table say, if it differs from the newest version."""
    spark = table.sparkSession
    newest = latest_version(spark, path)
    if newest is not None:
        held = spark.read.parquet(version_folder(path, newest))
        if held.columns == table.columns and _content(held) == _content(table):
            return newest
    return publish_version(table, path)


def publish_blocks(blocks: DataFrame, path: str, blocks6: DataFrame | None = None) -> int:
    """Cut and check address blocks, and store them as the next version."""
    version = _next(blocks.sparkSession, path)
    geo_blocks(blocks, blocks6=blocks6, store=version_folder(path, version))
    return version


class Followed(Generic[T]):
    """The newest version of a table, built when it is first asked for.

    `build(spark, folder)` measures and checks it, and raises for a table that must not be
    used; a stream then stops instead of counting wrongly.
    """

    def __init__(self, path: str, build: Callable[[SparkSession, str], T]):
        self.path = path
        self.build = build
        self._held: tuple[int, T] | None = None

    def current(self, spark: SparkSession) -> tuple[int, T]:
        version = latest_version(spark, self.path)
        if version is None:
            raise ValueError(f"no complete version in {self.path}")
        if self._held is None or self._held[0] != version:
            self._held = version, self.build(spark, version_folder(self.path, version))
        return self._held


def followed_lookup(
    path: str, key: str = "id", broadcast_bytes: int = BROADCAST_BYTES
) -> Followed[Lookup]:
    """A lookup table by its versions; keys are checked and its size measured in each."""
    return Followed(
        path, lambda spark, folder: lookup_table(spark.read.parquet(folder), key, broadcast_bytes)
    )


def followed_blocks(path: str, broadcast_bytes: int = BROADCAST_BYTES) -> Followed[GeoBlocks]:
    """Address blocks by the versions that `publish_blocks` stored."""
    return Followed(path, lambda spark, folder: stored_blocks(spark, folder, broadcast_bytes))
