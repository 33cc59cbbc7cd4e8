"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailstream.session import shared_folder

#: A word: anything between ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"

#: Ends a query's shuffles with the query, so that a chain of written steps keeps the
#: shuffle files of one step at a time on disk.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """`df`, written to the folder that all executors share and read again.

    Cuts the lineage: a lost executor costs the tasks it ran, not the steps before.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    before = spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEAN_SHUFFLES)
        else:
            spark.conf.set(CLEAN_SHUFFLES, before)
    frame = spark.read.schema(df.schema).parquet(path)
    frame.scratch_folder = path
    return frame


def forget(df: DataFrame) -> None:
    """Deletes what `written` wrote for `df`, once nothing reads it any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.scratch_folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text as an array, in order."""
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Parts of a batch, so that what Python builds from texts stays small."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def components(links: DataFrame, purpose: str) -> DataFrame:
    """node, root for links (a, b): root is the smallest node that links reach.

    Stars are contracted towards smaller nodes (large star, small star) until nothing
    changes.  Each step is a minimum per node and a join; nodes without links are left out.
    """

    def state(edges: DataFrame) -> tuple:
        return tuple(
            edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        )

    # a > b throughout.
    edges = links.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = written(edges.distinct(), purpose)
    now, before = state(edges), None
    while now != before:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), "m")
        large = written(large.where("a != m").distinct(), purpose)
        least = large.groupBy("a").agg(F.min("m").alias("least"))
        small = large.join(least, "a")
        small = (
            small.where("m != least")
            .select(F.col("m").alias("a"), F.col("least").alias("b"))
            .unionByName(least.select("a", F.col("least").alias("b")))
        )
        replaced = edges
        edges = written(small.distinct(), purpose)
        forget(replaced)
        forget(large)
        now, before = state(edges), now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
