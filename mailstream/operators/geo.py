"""IP address to country: a left range join over address blocks.

Blocks may be nested: the innermost one counts.  IPv4 blocks are any ranges; a sweep over
the borders inside each /16 network turns nested ones into disjoint segments.  A segment is
cut into whole /16 networks, then what is left into whole /20 networks, and the rest along
/24 networks.  Whole networks are found by an equality on the network number; a /24 piece
also needs a bounds check.  So an address meets at most one row per whole level and at most
the 256 pieces a /24 can be cut into, however the blocks lie: no hot network turns into a
list of candidates to scan, and a wide block does not turn into many rows.

IPv6 blocks are prefixes.  A prefix becomes the networks of the next level that it covers
(eight at most, but for prefixes shorter than the first level), where the longest prefix of a
network stays; only levels that occur are asked, longer ones first.  A prefix longer than the last level is found by its high half and bounds of
its low half, which the same sweep has made disjoint.  An address that stands for an IPv4
address is looked up as that.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mailstream.functions.ipv4 import ipv4_octets, network, octets_to_number
from mailstream.functions.ipv6 import high_half, ipv6_groups, low_half, mapped_ipv4
from mailstream.operators.lookup import BROADCAST_BYTES, HotKeys, left_join_static, row_bytes
from mailstream.session import shared_folder

WHOLE_BITS = (16, 12)
PIECE_BITS = 8
LEVELS6 = tuple(range(16, 65, 4))
#: Turns the order of unsigned 64-bit numbers into that of BIGINT.
SIGN = -(1 << 63)
BLOCKS6 = "net_hi bigint, net_lo bigint, prefix int, country string"
#: Cut blocks: kind says which level, lo and hi are null for whole networks.
CUT = "net bigint, lo bigint, hi bigint, country string, kind string"
#: Rows of this kind tell of blocks that overlap without being nested.
CLASH = "clash"


@dataclass(frozen=True)
class GeoBlocks:
    """Blocks cut to networks.

    `whole` has one table per size in `WHOLE_BITS`, of at most 2^16 and 2^20 rows
    as the segments are disjoint; `pieces` is measured, and `small` if it fits.
    `networks6` has (prefix length, table, small) of the IPv6 levels that occur,
    `pieces6` the longer prefixes; each is measured.
    """

    whole: tuple[DataFrame, ...]
    pieces: DataFrame
    small: bool
    networks6: tuple[tuple[int, DataFrame, bool], ...] = ()
    pieces6: tuple[DataFrame, bool] | None = None

    @property
    def all_small(self) -> bool:
        """Whether no lookup of an address needs a shuffle."""
        six = [small for _, _, small in self.networks6]
        return self.small and all(six) and (self.pieces6 is None or self.pieces6[1])


def innermost(ranges: DataFrame) -> DataFrame:
    """Disjoint segments of nested `ranges(family, net, lo, hi, size, country)`.

    Within a network the borders are read in order, as brackets: the number of ranges that
    are open is a running sum, and what closing a range gives back is the last range that
    opened at the depth that is left.  `size` orders ranges that begin or end together; it
    grows with the range.  `clash` marks a range that ends while one inside it is still open,
    and a second range with the same bounds and another country.
    """
    begin = F.struct(
        F.col("lo").alias("at"), F.lit(0).alias("closes"), (-F.col("size")).alias("rank")
    )
    end = F.struct(F.col("hi").alias("at"), F.lit(1).alias("closes"), F.col("size").alias("rank"))
    place = ["family", "net"]
    borders = ranges.select(*place, "hi", "country", F.explode(F.array(begin, end)).alias("b"))
    borders = borders.select(*place, "hi", "country", "b.*")
    order = ["at", "closes", "rank", "country"]
    in_order = Window.partitionBy(*place).orderBy(*order)
    before = F.lag(F.struct("closes", "at", "rank", "country")).over(in_order)
    after = F.lead(F.struct("closes", "at")).over(in_order)
    opens = F.col("closes") == 0
    depth = F.sum(F.when(opens, 1).otherwise(-1)).over(in_order)
    numbered = borders.withColumns({"depth": depth, "before": before, "after": after})
    numbered = numbered.withColumn("level", F.when(opens, F.col("depth")).otherwise(F.col("depth") + 1))
    # The last range that opened at a depth, up to here.
    opened = F.when(opens, F.struct("hi", "country"))
    within, of_level = (
        F.last(opened, ignorenulls=True).over(Window.partitionBy(*place, key).orderBy(*order))
        for key in ("depth", "level")
    )
    known = numbered.withColumns({"inside": within, "own": of_level})
    twin = F.expr(
        "closes = 0 and before.closes = 0 and before.at = at and before.rank = rank "
        "and not before.country <=> country"
    )
    clash = F.coalesce(twin, F.lit(False)) | F.expr("closes = 1 and own.hi <> at")
    # Bounds may be the least and the greatest number there is; beyond them is nothing.
    start = F.when(opens, F.col("at")).otherwise(F.try_add("at", F.lit(1)))
    stop = F.expr("if(after.closes = 0, try_subtract(after.at, 1), after.at)")
    segments = known.select(
        *place, start.alias("lo"), stop.alias("hi"), "inside.country", "depth", clash.alias("clash")
    )
    return segments.where("clash or (depth > 0 and lo <= hi)").drop("depth")


def _sixteenths(blocks: DataFrame) -> DataFrame:
    """IPv4 blocks, clipped to the /16 networks that they touch."""
    bits = WHOLE_BITS[0]
    nets = F.explode(F.sequence(network("lo", bits), network("hi", bits))).alias("net")
    parts = blocks.where("lo <= hi").select(
        F.lit("v4").alias("family"), nets, "lo", "hi", (F.col("hi") - F.col("lo")).alias("size"), "country"
    )
    first = F.shiftleft("net", bits)
    return parts.withColumns(
        {"lo": F.greatest("lo", first), "hi": F.least("hi", first + ((1 << bits) - 1))}
    )


def _struct(kind: str, net: str, lo: str = "cast(null as bigint)", hi: str = "cast(null as bigint)") -> str:
    return f"named_struct('kind', '{kind}', 'net', {net}, 'lo', {lo}, 'hi', {hi})"


def _pieces(begin: str, end: str) -> str:
    """`[begin, end]` along /24 networks; nothing if it is empty."""
    nets = f"sequence(shiftright({begin}, {PIECE_BITS}), shiftright({end}, {PIECE_BITS}))"
    start = f"shiftleft(n, {PIECE_BITS})"
    low, high = f"greatest({begin}, {start})", f"least({end}, {start} + {(1 << PIECE_BITS) - 1})"
    return f"transform(if({begin} <= {end}, {nets}, array()), n -> {_struct('v4', 'n', low, high)})"


def _cut(segments: DataFrame) -> DataFrame:
    """Rows of `CUT`: IPv4 segments cut along networks, IPv6 ones as they are."""
    wide, narrow = WHOLE_BITS
    inside = (1 << narrow) - 1
    # First and last network that lie entirely in a segment.
    first = f"shiftright(lo, {narrow}) + if((lo & {inside}) = 0, 0, 1)"
    last = f"shiftright(hi, {narrow}) - if((hi & {inside}) = {inside}, 0, 1)"
    known = segments.selectExpr("*", f"{first} as first", f"{last} as last")
    below = f"if(first <= last, shiftleft(first, {narrow}) - 1, hi)"
    above = f"if(first <= last, shiftleft(last + 1, {narrow}), hi + 1)"
    whole = f"transform(if(first <= last, sequence(first, last), array()), n -> {_struct(f'v4_{narrow}', 'n')})"
    found = f"""case when clash then array({_struct(CLASH, 'net')})
      when family = 'v6' then array({_struct('v6', 'net', 'lo', 'hi')})
      when lo = shiftleft(net, {wide}) and hi = lo + {(1 << wide) - 1}
        then array({_struct(f'v4_{wide}', 'net')})
      else concat({whole}, {_pieces('lo', below)}, {_pieces(above, 'hi')}) end"""
    rows = known.selectExpr("country", f"explode({found}) as piece")
    return rows.select("piece.net", "piece.lo", "piece.hi", "country", "piece.kind")


def _long_prefixes(blocks6: DataFrame) -> DataFrame:
    """Prefixes beyond the last level as ranges of the low half, in signed order."""
    network_bits = F.call_function("shiftleft", F.lit(-1).cast("bigint"), 128 - F.col("prefix"))
    last = F.col("net_lo").bitwiseOR(F.bitwise_not(network_bits))
    return blocks6.where(f"prefix > {LEVELS6[-1]}").select(
        F.lit("v6").alias("family"),
        F.col("net_hi").alias("net"),
        F.col("net_lo").bitwiseXOR(F.lit(SIGN)).alias("lo"),
        last.bitwiseXOR(F.lit(SIGN)).alias("hi"),
        (128 - F.col("prefix")).cast("bigint").alias("size"),
        "country",
    )


def _networks6(blocks6: DataFrame) -> DataFrame:
    """Rows of `CUT`: the networks of the next level that a prefix covers.

    Of several prefixes that cover a network the longest one stays.
    """
    level = F.lit(None).cast("int")
    for at in reversed(LEVELS6):
        level = F.when(F.col("prefix") <= at, F.lit(at)).otherwise(level)
    known = blocks6.where(f"prefix <= {LEVELS6[-1]}").withColumn("level", level)
    first = F.expr("shiftrightunsigned(net_hi, 64 - level)")
    # Networks of level 64 may be negative numbers; they are still consecutive.
    nets = F.explode(F.sequence(first, first + F.expr("shiftleft(1L, level - prefix) - 1")))
    covered = known.select("level", "prefix", "country", nets.alias("net"))
    longest = covered.groupBy("level", "net").agg(
        F.max(F.struct("prefix", "country")).alias("one"),
        F.min(F.struct(-F.col("prefix"), "country")).alias("other"),
    )
    nothing = F.lit(None).cast("bigint")
    same = F.col("one.country").eqNullSafe(F.col("other.country"))
    kind = F.when(same, F.concat(F.lit("v6_"), "level")).otherwise(CLASH)
    return longest.select(
        "net", nothing.alias("lo"), nothing.alias("hi"), "one.country", kind.alias("kind")
    )


def geo_blocks(
    blocks: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
    blocks6: DataFrame | None = None,
    store: str | None = None,
) -> GeoBlocks:
    """Cut, check and measure `blocks(lo BIGINT, hi BIGINT, country STRING)`.

    `blocks6(net_hi BIGINT, net_lo BIGINT, prefix INT, country STRING)` adds IPv6
    prefixes: the halves of the network address and how many bits count.

    Of nested blocks the innermost counts.  Blocks that overlap otherwise, or have the same
    bounds and different countries, are an error.  The cut blocks are stored once, in the
    new folder `store` or in the shared folder, and read from there by each join and
    micro-batch; `stored_blocks` opens them again.
    """
    spark = blocks.sparkSession
    ranges = _sixteenths(blocks)
    if blocks6 is not None:
        ranges = ranges.unionByName(_long_prefixes(blocks6))
    cut = _cut(innermost(ranges))
    if blocks6 is not None:
        cut = cut.unionByName(_networks6(blocks6))
    path = store or shared_folder(spark, "blocks")
    cut.hint("rebalance", "kind").write.partitionBy("kind").parquet(path)
    return stored_blocks(spark, path, broadcast_bytes)


def stored_blocks(
    spark: SparkSession, path: str, broadcast_bytes: int = BROADCAST_BYTES
) -> GeoBlocks:
    """What `geo_blocks` stored, measured by one job."""
    cut = spark.read.schema(CUT).parquet(path)
    sizes = cut.groupBy("kind").agg(F.sum(row_bytes(cut.drop("kind"))).alias("bytes"))
    found = {row["kind"]: row["bytes"] for row in sizes.collect()}
    if CLASH in found:
        raise ValueError("address blocks overlap without one being inside the other")

    def table(kind: str, *columns: str) -> DataFrame:
        return cut.where(F.col("kind") == kind).select(*columns)

    whole = tuple(table(f"v4_{bits}", "net", "country") for bits in WHOLE_BITS)
    bounded = ("net", "lo", "hi", "country")
    networks6 = tuple(
        (level, table(f"v6_{level}", "net", "country"), found[f"v6_{level}"] <= broadcast_bytes)
        for level in LEVELS6
        if f"v6_{level}" in found
    )
    pieces6 = (table("v6", *bounded), found["v6"] <= broadcast_bytes) if "v6" in found else None
    small = found.get("v4", 0) <= broadcast_bytes
    return GeoBlocks(whole, table("v4", *bounded), small, networks6, pieces6)


def address_numbers(rows: DataFrame, ip: str = "request_ip") -> DataFrame:
    """Add `__address` (IPv4, also that of a mapped address) and `__high`, `__low` (IPv6)."""
    cut = rows.withColumns({"__octets": ipv4_octets(ip), "__groups": ipv6_groups(ip)})
    groups = F.col("__groups")
    numbers = cut.withColumns(
        {
            "__address": F.coalesce(octets_to_number("__octets"), mapped_ipv4(groups)),
            "__high": high_half(groups),
            "__low": low_half(groups).bitwiseXOR(F.lit(SIGN)),
        }
    )
    return numbers.drop("__octets", "__groups")


def _levels(blocks: GeoBlocks) -> list[tuple[str, Column, DataFrame, bool]]:
    """(name, the rows' network, table, small) of each join; the longest IPv6 prefixes first."""
    levels = [
        (f"v4_{bits}", network("__address", bits), table, True)
        for bits, table in zip(WHOLE_BITS, blocks.whole, strict=True)
    ]
    levels.append(("v4", network("__address", PIECE_BITS), blocks.pieces, blocks.small))
    if blocks.pieces6:
        levels.append(("v6", F.col("__high"), *blocks.pieces6))
    for level, table, small in reversed(blocks.networks6):
        levels.append((f"v6_{level}", F.shiftrightunsigned("__high", 64 - level), table, small))
    return levels


def shuffled_networks(blocks: GeoBlocks) -> dict[str, Column]:
    """The keys of the joins that need a shuffle, over `address_numbers`."""
    return {name: key for name, key, _, small in _levels(blocks) if not small}


def ip_to_country(
    rows: DataFrame, blocks: GeoBlocks, ip: str = "request_ip", hot: HotKeys | None = None
) -> DataFrame:
    """Add `country`; NULL for an address outside all blocks or a malformed one."""
    found = address_numbers(rows, ip)
    countries = []
    for name, key, table, small in _levels(blocks):
        names = table.select(*(F.col(n).alias(f"__{name}_{n}") for n in table.columns))
        inside = None
        if "lo" in table.columns:
            place = F.col("__address" if name == "v4" else "__low")
            inside = place.between(F.col(f"__{name}_lo"), F.col(f"__{name}_hi"))
        salts = (hot or {}).get(name)
        found = left_join_static(found, names, key, f"__{name}_net", small, inside, salts)
        countries.append(F.col(f"__{name}_country"))
    return found.select(*rows.columns, F.coalesce(*countries).alias("country"))
