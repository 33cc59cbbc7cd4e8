"""Document fingerprints: threshold-scaled sketches of word shingles, in built-ins only.

A sketch keeps the hash of every five-word shingle that lies below a fixed fraction of the
hash range.  The same fraction for all documents makes sketches mergeable (the union of two
sketches is the sketch of both texts) and lets a short text be found inside a long one
(`containment`), however unequal they are.  A text of one to four words has one shingle.
A text none of whose hashes lies below the fraction keeps its smallest one, so that only
texts without words have an empty sketch.

Null text counts as empty.  Documents are ordered by doc_id (null first), then text;
repeated rows are neighbours of their own.  Two empty sketches are alike (1.0), an empty
and another one are not (0.0).  Only doc_id and text are read; other columns do not matter.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mailstream.llm.common import text_or_empty, words_of, written

SHINGLE_WORDS = 5
FRACTION = 0.25
#: Rows whose neighbours are found in one sorted group.
GROUP_ROWS = 2000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, not once for each element of a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def limit_of(fraction: float) -> Column:
    """Hashes below it are kept."""
    return F.lit(min(int(fraction * 2.0**63), (1 << 63) - 1))


def sketch(text: Column, fraction: float = FRACTION) -> Column:
    """Ascending distinct hashes below the fraction, as array<long>."""
    limit = limit_of(fraction)

    def shingles(words: Column) -> Column:
        last = F.greatest(F.size(words) - SHINGLE_WORDS, F.lit(0))
        starts = F.sequence(F.lit(0), last)

        def hashed(i: Column) -> Column:
            parts = [F.get(words, i + k) for k in range(SHINGLE_WORDS)]
            return F.shiftrightunsigned(F.xxhash64(*parts), 1)

        return F.when(F.size(words) > 0, F.transform(starts, hashed)).otherwise(
            F.array().cast("array<long>")
        )

    def kept(hashes: Column) -> Column:
        below = F.filter(hashes, lambda h: h < limit)
        least = F.array(F.array_min(hashes))
        return F.when((F.size(below) == 0) & (F.size(hashes) > 0), least).otherwise(below)

    hashes = let(words_of(text), shingles)
    return F.array_sort(F.array_distinct(let(hashes, kept)))


def fingerprint(sketch_: Column) -> Column:
    """A sketch as text, 16 hex digits a hash."""
    return F.array_join(F.transform(sketch_, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def merge(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """The sketch of two texts taken together, both sketched with this fraction.

    The hash that stands for a text without one below the limit counts only as long as the
    whole has none either.
    """
    below = F.filter(F.array_union(a, b), lambda h: h < limit_of(fraction))
    least = F.array_compact(F.array(F.least(F.array_min(a), F.array_min(b))))
    return F.array_sort(F.when(F.size(below) > 0, below).otherwise(least))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the texts' shingles."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def containment(a: Column, b: Column) -> Column:
    """Estimated part of a's shingles that b has."""
    both = F.size(F.array_intersect(a, b))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(both / F.size(a))


def with_next(docs: DataFrame) -> tuple[DataFrame, Window]:
    """doc_id, text, next_text, group, extra, and the window that orders each group.

    Groups are ranges of doc_id.  The first document of the following group is added to
    each group as an extra row (to be filtered out), so one shuffle of the texts is enough
    and no task sees the whole order.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty().alias("text"))
    ids = rows.select("doc_id")
    low, high, count = ids.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).first()
    low, high = low or 0, high or 0
    width = max(1, -(-(high - low + 1) * GROUP_ROWS // max(count, 1)))
    # Null ids form the group before all others.
    group = F.coalesce(F.floor((F.col("doc_id") - low) / F.lit(width)), F.lit(-1))
    heads = ids.withColumn("group", group.cast("long")).groupBy("group").agg(
        F.min("doc_id").alias("head_id")
    )
    # One row for each group: ordered within blocks of groups, then across blocks, of which
    # there is one for GROUP_ROWS * 4096 documents.
    block = F.floor(F.col("group") / 4096)
    heads = heads.withColumn("block", block)
    firsts = heads.groupBy("block").agg(F.min("group").alias("first_group"))
    across = Window.orderBy("block")
    firsts = firsts.select(
        "block", F.lead("first_group").over(across).alias("later_group")
    )
    least = heads.agg(F.min("group").alias("least_group"))
    inside = Window.partitionBy("block").orderBy("group")
    following = (
        heads.withColumn("next_group", F.lead("group").over(inside))
        .join(firsts, "block")
        .join(F.broadcast(least))  # one row
        .select(
            "group",
            F.coalesce("next_group", "later_group", "least_group").alias("next_group"),
        )
    )
    named = heads.select(F.col("group").alias("next_group"), "head_id")
    # Written, so that Spark knows its size when it chooses how the texts meet it.
    extra = written(
        following.join(named, "next_group").select("group", "head_id"), "sketch-heads"
    )
    firsts_text = (
        rows.join(
            extra.select("head_id").distinct(),
            rows["doc_id"].eqNullSafe(F.col("head_id")),
        )
        .groupBy("head_id")
        .agg(F.min("text").alias("text"))
    )
    extras = (
        extra.withColumnRenamed("head_id", "wanted")
        .join(firsts_text, F.col("wanted").eqNullSafe(F.col("head_id")))
        .select(
            F.col("head_id").alias("doc_id"), "text", "group", F.lit(True).alias("extra")
        )
    )
    grouped = rows.withColumn("group", group.cast("long")).withColumn("extra", F.lit(False))
    order = Window.partitionBy("group").orderBy("extra", "doc_id", "text")
    lead = F.lead("text").over(order)
    return grouped.unionByName(extras).withColumn("next_text", lead), order


def fingerprints(docs: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """Fingerprints of each text and of its edited form, and how alike they are.

    Edited: the last quarter of the code points gives way to the beginning of the next
    document's text.
    """
    rows, order = with_next(docs)
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), n - quarter),
        F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), quarter),
    )
    rows = rows.select(
        "doc_id",
        "group",
        "extra",
        "text",
        n.cast("long").alias("n_chars"),
        F.sha2(edited, 256).alias("edited_sha256"),
        sketch(F.col("text"), fraction).alias("own"),
        F.when(~F.col("extra"), sketch(edited, fraction)).alias("edited"),
    )
    rows = rows.withColumn("next", F.lead("own").over(order)).where(~F.col("extra"))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
    )
