"""Left joins against static tables.

A table is measured when it is declared, or when a stream takes up a new version of it.  One
that fits the byte limit is broadcast, so the facts are not shuffled.  A larger one is joined
through a shuffle.  There, rows without a key are dealt out by their content, as they meet
nothing.  Keys that were measured as hot are salted: their rows are dealt to as many salts as
their share of the rows calls for, and only their table rows are repeated.  A batch need not
measure: adaptive execution splits the partition of a hot key.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 128 * 1024 * 1024
ROW_OVERHEAD_BYTES = 32
#: A key is hot from this share of the rows; so there are no more than its inverse of them.
HOT_SHARE = 1 / 32
#: Entries of the sketch that finds hot keys: far more than there can be hot keys.
SKETCH_ENTRIES = 1024
SALT = "__salt"

#: For each join, by name, how many salts each hot key has, the key as text.
HotKeys = Mapping[str, Mapping[str, int]]


def row_bytes(table: DataFrame) -> Column:
    """Rough in-memory size of a row: 8 bytes a column, plus text length."""
    size = F.lit(ROW_OVERHEAD_BYTES + 8 * len(table.columns))
    for name, kind in table.dtypes:
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(name), F.lit(0))
    return size.cast("bigint")


@dataclass(frozen=True)
class Lookup:
    """A static table, the column it is looked up by, and whether it is small."""

    table: DataFrame
    key: str
    small: bool


def lookup_table(
    table: DataFrame,
    key: str = "id",
    broadcast_bytes: int = BROADCAST_BYTES,
    check_unique: bool = True,
    cache: bool = False,
) -> Lookup:
    """Measure a table with one aggregate job and wrap it for `left_lookup`.

    A repeated key would multiply fact rows and inflate every count, so it is an
    error unless `check_unique` is off.  An uncached table is read again by each
    micro-batch and so stays fresh; a cached one is frozen until restart.
    """
    if cache:
        table = table.persist()
    measures = [F.sum(row_bytes(table)).alias("bytes")]
    if check_unique:
        measures += [
            F.count(key).alias("keys"),
            F.count_distinct(key).alias("distinct_keys"),
        ]
    found = table.agg(*measures).first()
    if check_unique and found["keys"] != found["distinct_keys"]:
        extra = found["keys"] - found["distinct_keys"]
        raise ValueError(f"lookup column {key!r} is not unique: {extra} repeated rows")
    return Lookup(table, key, (found["bytes"] or 0) <= broadcast_bytes)


def hot_keys(rows: DataFrame, keys: Mapping[str, Column], pieces: int) -> dict[str, dict[str, int]]:
    """For each named key, the values that hold `HOT_SHARE` of the rows or more.

    One aggregate job with a frequent-items sketch of a fixed size for each key; what comes
    to the driver is as many values at most.  A value gets a salt for each of `pieces`
    partitions that its share of the rows would fill.
    """
    if not keys:
        return {}
    texts = rows.select(*(key.cast("string").alias(name) for name, key in keys.items()))
    most = ceil(1 / HOT_SHARE)
    found = texts.agg(
        F.count(F.lit(1)).alias("rows"),
        *(
            F.call_function("approx_top_k", F.col(name), F.lit(most), F.lit(SKETCH_ENTRIES)).alias(f"top_{name}")
            for name in keys
        ),
    ).first()
    rows_in_all = found["rows"]
    return {
        name: {
            item["item"]: max(2, ceil(pieces * item["count"] / rows_in_all))
            for item in found[f"top_{name}"] or ()
            if item["item"] is not None and item["count"] >= HOT_SHARE * rows_in_all
        }
        for name in keys
    }


def _salts_of(key: Column, salts: Mapping[str, int]) -> Column:
    """How many salts a key has; 1 unless it is hot."""
    pairs = [F.lit(part) for pair in salts.items() for part in pair]
    if not pairs:
        return F.lit(1)
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key.cast("string")), F.lit(1))


def left_join_static(
    rows: DataFrame,
    table: DataFrame,
    key: Column,
    table_key: str,
    small: bool,
    inside: Column | None = None,
    salts: Mapping[str, int] | None = None,
) -> DataFrame:
    """`rows LEFT JOIN table ON key = table_key AND inside`.

    The strategy is the one the table's size calls for.  Salts come from the content of a
    row, so a retried task draws the same ones.  The table may not share column names with
    the rows.
    """
    same = key == F.col(table_key)
    if inside is not None:
        same = same & inside
    if small:
        return rows.join(F.broadcast(table), same, "left")
    content = F.xxhash64(*rows.columns)
    own = _salts_of(key, salts or {}).cast("bigint")
    # A row without a key meets nothing wherever it goes.
    salt = F.when(key.isNull(), content).otherwise(F.pmod(content, own))
    last = (_salts_of(F.col(table_key), salts or {}) - 1).cast("bigint")
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), last))
    repeated = table.withColumn("__table_salt", copies)
    salted = rows.withColumn(SALT, salt)
    joined = salted.join(repeated, same & (F.col(SALT) == F.col("__table_salt")), "left")
    return joined.drop(SALT, "__table_salt")


def lookup_key(lookup: Lookup, fact_key: str) -> Column:
    """The fact key, which is text, as whatever type the table's key has."""
    return F.col(fact_key).try_cast(lookup.table.schema[lookup.key].dataType)


def left_lookup(
    rows: DataFrame,
    lookup: Lookup,
    fact_key: str,
    column: str,
    name: str,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Add `lookup.column` as `name`; NULL when the key is unknown or malformed."""
    slim = lookup.table.select(
        F.col(lookup.key).alias("__key"), F.col(column).alias(name)
    )
    key, salts = lookup_key(lookup, fact_key), (hot or {}).get(fact_key)
    return left_join_static(rows, slim, key, "__key", lookup.small, salts=salts).drop("__key")


def join_isp(rows: DataFrame, isp_domains: Lookup, hot: HotKeys | None = None) -> DataFrame:
    """Provider name of each row's `isp_id`."""
    return left_lookup(rows, isp_domains, "isp_id", "domain_name", "domain_name", hot)


def join_lists(rows: DataFrame, lists: Lookup, hot: HotKeys | None = None) -> DataFrame:
    """List name (the table's `code`) of each row's `list_id`."""
    return left_lookup(rows, lists, "list_id", "code", "list_name", hot)
