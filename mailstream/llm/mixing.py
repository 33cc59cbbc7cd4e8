"""Mixing sources to target weights by pivotal dependent rounding.

A source of size S (words) gets the target T by weight, at most `most` * S, what is above
being shared again by weight.  Each document should be taken T / S times.  The whole part
is taken; the fraction is rounded to 0 or 1 copy by the pivotal method: two documents of a
source with open fractions meet, words move from one to the other, in a random direction,
until one fraction is 0 or 1, so that every document keeps its expectation and the words of
the pair do not change.  Documents meet first within small leaves (a hash of the document),
then the one open document a leaf leaves over meets those of other leaves, level by level
in a tree with a bounded fan-in, so that a source with a third of all rows is spread over
as many leaves as it needs.  At the root one document of a source is rounded by chance,
so a source misses its target by less than one document.

Null text has size 0; a document of size 0 is taken 0 words, wherever it stands.  Null
source is a source of its own, last in order.  Repeated rows are documents of their own
that end up with the same set of results in any order.  All choices come from hashes, so
reruns agree.  An empty table gives an empty result.  Other columns of the table do not
matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mailstream.llm.common import WORD, text_or_empty, written

LEAF_ROWS = 4096
FAN_IN = 256
#: Word counts add up to exact integers; a fraction this close to 0 or 1 is integral.
CLOSE = 1e-9

OPEN = (
    "doc_id long, size long, source_size long, target double, doc_no long, "
    "whole long, part double, group long, key long, open boolean"
)


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), most: float = 3.0
) -> DataFrame:
    """source, source_size, rows, target for (source, size) rows.

    Sources are numbered in code point order by counting per range of names, not in one
    sorted task.  Each round of sharing is one aggregate over the sources.
    """
    spark = sizes.sparkSession
    totals = written(
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
        .repartitionByRange(F.col("source").asc_nulls_last())
        .sortWithinPartitions(F.col("source").asc_nulls_last())
        .withColumn("range", F.spark_partition_id()),
        "mix-sources",
    )
    in_range = Window.partitionBy("range").orderBy(F.col("source").asc_nulls_last())
    counts = {
        row["range"]: row["count"] for row in totals.groupBy("range").count().collect()
    }
    offsets, before = [], 0
    for number in sorted(counts):
        offsets.append((number, before))
        before += counts[number]
    offset = spark.createDataFrame(offsets, "range int, before long")
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.pmod(F.col("before") + F.col("nth") - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    shares = written(
        totals.withColumn("nth", F.row_number().over(in_range))
        .join(offset, "range")
        .select(
            "source",
            "source_size",
            "rows",
            weight.alias("weight"),
            (F.col("source_size") * most).alias("limit"),
        ),
        "mix-weights",
    )
    total = shares.agg(F.sum("source_size")).first()[0] or 0
    # A source that is at its limit stays there, as the share of a weight only grows.
    share, full = 0.0, -1
    while True:
        over = F.col("limit") <= F.col("weight") * share
        row = shares.agg(
            F.sum(F.when(over, F.col("limit")).otherwise(0.0)),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))),
            F.sum(F.when(over, 1).otherwise(0)),
        ).first()
        taken, weighing, now_full = row[0] or 0.0, row[1] or 0.0, row[2] or 0
        if now_full == full or weighing == 0:
            break
        share, full = (total - taken) / weighing, now_full
    return shares.select(
        "source",
        "source_size",
        "rows",
        F.least("limit", F.col("weight") * F.lit(share)).alias("target"),
    )


def _random(*parts: object) -> float:
    data = "|".join(map(str, parts)).encode()
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest()) / 2**64


def _pivot(rows: pd.DataFrame, seed: int, level: int) -> pd.DataFrame:
    """Rounds all fractions of one group but one at most."""
    rows = rows.sort_values(["doc_no", "doc_id", "size"], kind="stable").reset_index(
        drop=True
    )
    size, part = rows["size"].to_numpy(float), rows["part"].to_numpy(float).copy()
    number = rows["doc_no"].to_numpy()
    is_open = np.zeros(len(rows), bool)
    held = -1
    for i in range(len(rows)):
        if part[i] < CLOSE or part[i] > 1 - CLOSE:
            part[i] = round(part[i])
            continue
        if held < 0:
            held = i
            continue
        # Words that can move from i to held, and from held to i.
        up = min(part[i] * size[i], (1 - part[held]) * size[held])
        down = min(part[held] * size[held], (1 - part[i]) * size[i])
        toss = _random(seed, level, number[held], number[i])
        gained = up if toss * (up + down) < down else -down
        part[held] += gained / size[held]
        part[i] -= gained / size[i]
        for j in (held, i):
            if part[j] < CLOSE or part[j] > 1 - CLOSE:
                part[j] = round(part[j])
        left = [j for j in (held, i) if 0 < part[j] < 1]
        held = left[0] if left else -1
    if held >= 0:
        is_open[held] = True
    rows["part"], rows["open"] = part, is_open
    return rows


def _rounder(seed: int, level: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def rounded(group: pd.DataFrame) -> pd.DataFrame:
        return _pivot(group, seed, level)

    return rounded


def mix_sources(
    docs: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    most: float = 3.0,
    seed: int = 7,
) -> DataFrame:
    """doc_id, size, source_size, target, copies, taken, doc_no per row of `docs`.

    doc_no is a hash of doc_id and text; with repeated rows it is not unique.
    """
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        docs["source"].cast("string").alias("source"),
        word_count(text_or_empty()).alias("size"),
        F.xxhash64(docs["doc_id"], docs["text"]).alias("doc_no"),
    )
    rows = written(rows, "mix-sizes")
    targets = source_targets(rows, weights, most).withColumn(
        "key", F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull())
    )
    targets = written(targets, "mix-targets")
    ratio = F.when(
        F.col("source_size") > 0, F.col("target") / F.col("source_size")
    ).otherwise(F.lit(0.0))
    leaves = F.ceil(F.col("rows") / LEAF_ROWS)
    # There is a row for each source here, so hot sources split in a join as usual.
    named = targets.withColumnRenamed("source", "named")
    placed = rows.join(named, F.col("source").eqNullSafe(F.col("named")))
    placed = placed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        "doc_no",
        F.floor(ratio).alias("whole"),
        F.when(F.col("size") > 0, ratio - F.floor(ratio)).otherwise(0.0).alias("part"),
        F.pmod(F.hash("doc_no", F.lit(seed)).cast("long"), leaves).alias("group"),
        "key",
        F.lit(True).alias("open"),
    )
    most_leaves = targets.agg(F.max(leaves)).first()[0] or 1
    done, level = [], 0
    open_rows = placed
    while True:
        # Leaves of a few thousand rows, then nodes of FAN_IN rows.
        result = written(
            open_rows.groupBy("key", "group").applyInPandas(_rounder(seed, level), OPEN),
            f"mix-level-{level}",
        )
        done.append(result.where(~F.col("open")))
        open_rows = result.where("open")
        if most_leaves <= 1:
            break
        open_rows = open_rows.withColumn("group", F.floor(F.col("group") / FAN_IN))
        most_leaves = -(-most_leaves // FAN_IN)
        level += 1
    toss = F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    done.append(open_rows.withColumn("part", F.when(toss < F.col("part"), 1.0).otherwise(0.0)))
    everything = done[0]
    for piece in done[1:]:
        everything = everything.unionByName(piece)
    copies = (F.col("whole") + F.round("part").cast("long")).alias("copies")
    return everything.select(
        "doc_id", "size", "source_size", "target", copies, "doc_no"
    ).withColumn("taken", F.col("copies") * F.col("size"))


def copies_of(mixed: DataFrame, docs: DataFrame) -> DataFrame:
    """The rows of `docs`, each as often as `mixed` takes it."""
    counted = mixed.groupBy("doc_id", "doc_no").agg(
        F.sum("copies").alias("_copies"), F.count("*").alias("_rows")
    )
    numbered = docs.withColumn("_doc_no", F.xxhash64(docs["doc_id"], docs["text"]))
    joined = numbered.join(
        counted.select(
            F.col("doc_id").alias("_doc_id"),
            F.col("doc_no").alias("_no"),
            "_copies",
            "_rows",
        ),
        F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("_doc_no") == F.col("_no")),
    )
    # Equal rows share their copies: one row speaks for all of them.
    once = joined.where("_rows = 1").unionByName(
        joined.where("_rows > 1").dropDuplicates(["_doc_no", "_doc_id"])
    )
    return (
        once.where("_copies > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
        .select(*docs.columns)
    )

