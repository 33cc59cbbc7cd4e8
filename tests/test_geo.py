"""Range join of addresses against a brute force over all blocks."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from mailstream.functions.ipv4 import ipv4_octets, octets_to_number
from mailstream.operators.geo import (
    address_numbers,
    geo_blocks,
    ip_to_country,
    shuffled_networks,
    stored_blocks,
)
from mailstream.sources.geo import cidr_blocks, cidr_blocks6, read_geo_blocks, read_geo_blocks6

TOP = 2**32


def random_blocks(seed):
    """Disjoint blocks of every width, some aligned, some not, some touching."""
    rng = random.Random(seed)
    blocks, at = [(0, 5, "first")], 6
    while True:
        at += rng.choice([0, 0, 1, 255, 4096, rng.randrange(1, 2**22)])
        width = rng.choice([1, 2, 256, 257, 4096, 65536, 2**17, rng.randrange(1, 2**26)])
        if rng.random() < 0.3:
            at = -(-at // 65536) * 65536
        if at + width >= TOP - 10:
            break
        blocks.append((at, at + width - 1, f"c{len(blocks) % 7}"))
        at += width
    return blocks + [(TOP - 3, TOP - 1, "last")]


def text(number):
    return ".".join(str(number >> shift & 255) for shift in (24, 16, 8, 0))


def probes(blocks, seed):
    rng = random.Random(seed)
    near = [b + d for lo, hi, _ in blocks for b in (lo, hi) for d in (-1, 0, 1)]
    numbers = {n for n in near if 0 <= n < TOP} | {rng.randrange(TOP) for _ in range(500)}
    return sorted(numbers)


def expected(blocks, number):
    return next((c for lo, hi, c in blocks if lo <= number <= hi), None)


def salts_for(rows, cut):
    """Salts for some keys of each join that needs a shuffle, hot or not."""
    numbers = address_numbers(rows)
    return {
        name: {str(r[0]): 3 for r in numbers.select(key).where(key.isNotNull()).distinct().limit(20).collect()}
        for name, key in shuffled_networks(cut).items()
    }


@pytest.mark.parametrize("form", ["broadcast", "shuffled", "salted"])
def test_same_as_brute_force(spark, form):
    blocks = random_blocks(1)
    numbers = probes(blocks, 2)
    table = spark.createDataFrame(blocks, "lo bigint, hi bigint, country string")
    limit = {"broadcast_bytes": 0} if form != "broadcast" else {}
    cut = geo_blocks(table, **limit)
    assert cut.small == (form == "broadcast")
    rows = spark.createDataFrame([(text(n), n) for n in numbers], "request_ip string, n bigint")
    hot = salts_for(rows, cut) if form == "salted" else None
    found = {r["n"]: r["country"] for r in ip_to_country(rows, cut, hot=hot).collect()}
    assert found == {n: expected(blocks, n) for n in numbers}
    assert ip_to_country(rows, cut, hot=hot).count() == len(numbers)


def test_whole_levels_keep_wide_blocks_small(spark):
    table = spark.createDataFrame([(0, TOP - 1, "all")], "lo bigint, hi bigint, country string")
    cut = geo_blocks(table)
    assert [level.count() for level in cut.whole] == [65536, 0]
    assert cut.pieces.count() == 0


def test_blocks_are_cut_once_and_opened_again(spark, tmp_path):
    table = spark.createDataFrame([(5, 2**24, "a"), (9, 9, "b")], "lo bigint, hi bigint, country string")
    rows = spark.createDataFrame([("0.0.0.8",), ("0.0.0.9",), ("0.9.9.9",)], "request_ip string")
    store = str(tmp_path / "blocks")
    for cut in (geo_blocks(table, store=store), stored_blocks(spark, store)):
        found = ip_to_country(rows, cut)
        assert {r["request_ip"]: r["country"] for r in found.collect()} == {"0.0.0.8": "a", "0.0.0.9": "b", "0.9.9.9": "a"}
        text = found._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in text and "Exchange hashpartitioning" not in text


def test_malformed_addresses_have_no_country(spark):
    bad = ["", "1.2.3", "1.2.3.4.5", "256.1.1.1", "1.2.3.04", " 1.2.3.4", "a.b.c.d", "::1", None]
    table = spark.createDataFrame([(0, TOP - 1, "all")], "lo bigint, hi bigint, country string")
    rows = spark.createDataFrame([(b,) for b in [*bad, "0.0.0.0", "255.255.255.255"]], "request_ip string")
    found = ip_to_country(rows, geo_blocks(table)).collect()
    assert [r["country"] for r in found] == [None] * len(bad) + ["all", "all"]


def test_address_numbers(spark):
    rows = spark.createDataFrame([("1.2.3.4",), ("255.255.255.255",)], "ip string")
    octets = rows.select(ipv4_octets("ip").alias("o"))
    found = octets.select(octets_to_number(F.col("o")).alias("n")).collect()
    assert [r["n"] for r in found] == [16909060, TOP - 1]


@pytest.mark.parametrize(
    "blocks",
    [
        [(0, 10, "a"), (10, 20, "b")],
        [(0, 2**25, "a"), (2**24, 2**25 + 5, "b")],
        [(0, 100, "a"), (2, 50, "b"), (40, 60, "c")],
        [(5, 9, "a"), (5, 9, "b")],
    ],
)
def test_blocks_that_overlap_without_nesting_are_refused(spark, blocks):
    table = spark.createDataFrame(blocks, "lo bigint, hi bigint, country string")
    with pytest.raises(ValueError, match="overlap"):
        geo_blocks(table)


def nested_blocks(seed):
    """Ranges inside ranges, many levels deep, that share borders and repeat."""
    rng = random.Random(seed)
    blocks = []

    def fill(lo, hi, depth):
        blocks.append((lo, hi, f"c{len(blocks)}"))
        at = lo
        while depth < 9 and at <= hi and rng.random() < 0.9:
            width = max(1, (hi - lo + 1) // rng.choice([1, 2, 4, 16, 256]))
            end = min(hi, at + width - 1)
            if (at, end) != (lo, hi):
                fill(at, end, depth + 1)
            at = end + 1 + rng.choice([0, 0, 1, 5, 65536])

    for first in (0, 10 << 24, 77 << 24, (TOP - 2**26)):
        fill(first, first + 2**26 - 1, 0)
    return blocks + blocks[:3]


@pytest.mark.parametrize("form", ["broadcast", "salted"])
def test_the_innermost_of_nested_blocks_counts(spark, form):
    blocks = nested_blocks(5)
    assert len(blocks) > 100
    table = spark.createDataFrame(blocks, "lo bigint, hi bigint, country string")
    cut = geo_blocks(table, **({"broadcast_bytes": 0} if form == "salted" else {}))
    numbers = probes(blocks[:400], 6)
    smallest = sorted(blocks, key=lambda block: block[1] - block[0])
    rows = spark.createDataFrame([(text(n), n) for n in numbers], "request_ip string, n bigint")
    hot = salts_for(rows, cut) if form == "salted" else None
    found = {r["n"]: r["country"] for r in ip_to_country(rows, cut, hot=hot).collect()}
    assert found == {n: expected(smallest, n) for n in numbers}


def test_prefixes_of_both_families_nest(spark):
    nets = ["10.0.0.0/8", "10.1.0.0/16", "10.1.2.0/24", "10.1.2.3/32", "0.0.0.0/0",
            "2001:db8::/32", "2001:db8:1::/48", "2001:db8:1:2::/64", "2001:db8:1:2:8000::/65",
            "2001:db8:1:2:8000::5/128", "2001:db8::/36", "2000::/3"]
    frame = spark.createDataFrame([(n,) for n in nets], "country string")
    four = cidr_blocks(frame, "country").select("lo", "hi", "country")
    six = cidr_blocks6(frame, "country").select("net_hi", "net_lo", "prefix", "country")
    parsed = [ipaddress.ip_network(n) for n in nets]
    probes_ = {int(net[k]) + d: net.version for net in parsed for k in (0, -1) for d in (-1, 0, 1)}
    addresses = [
        (ipaddress.IPv4Address if version == 4 else ipaddress.IPv6Address)(n)
        for n, version in probes_.items()
        if 0 <= n < (TOP if version == 4 else 2**128)
    ]
    want = {}
    for address in addresses:
        inside = [net for net in parsed if net.version == address.version and address in net]
        want[str(address)] = str(max(inside, key=lambda net: net.prefixlen)) if inside else None
    rows = spark.createDataFrame([(t,) for t in want], "request_ip string")
    for limit in ({}, {"broadcast_bytes": 0}):
        found = ip_to_country(rows, geo_blocks(four, blocks6=six, **limit))
        assert {r["request_ip"]: r["country"] for r in found.collect()} == want


def test_rows_without_an_address_are_spread(spark):
    """Joins that need a shuffle do not bring all rows of the other family together."""
    six = spark.createDataFrame([(1 << 60, 0, 48, "six")], "net_hi bigint, net_lo bigint, prefix int, country string")
    four = spark.createDataFrame([(0, 9, "four")], "lo bigint, hi bigint, country string")
    cut = geo_blocks(four, blocks6=six, broadcast_bytes=0)
    assert not cut.all_small and set(shuffled_networks(cut)) == {"v4", "v6_48"}
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = spark.range(4000).select(F.concat(F.lit("0.0.0."), F.col("id") % 200).alias("request_ip"), "id")
        sizes = ip_to_country(rows, cut).groupBy(F.spark_partition_id()).count().collect()
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert sum(r["count"] for r in sizes) == 4000 and max(r["count"] for r in sizes) < 1500


def test_blocks_from_csv(spark, tmp_path):
    (tmp_path / "nets.csv").write_text(
        "network,geoname_id,extra\n10.0.0.0/8,1,x\n192.168.1.128/25,2,x\n"
        "1.1.1.1/32,3,x\n2001:db8::/32,1,x\n9.0.0.0/8,,x\n"
    )
    (tmp_path / "places.csv").write_text("geoname_id,country_iso_code\n1,AA\n2,BB\n3,\n")
    paths = str(tmp_path / "nets.csv"), str(tmp_path / "places.csv")
    six = read_geo_blocks6(spark, *paths).collect()
    assert [tuple(r) for r in six] == [(0x20010DB8 << 32, 0, 32, "AA")]
    blocks = read_geo_blocks(spark, *paths)
    assert sorted(tuple(r) for r in blocks.select("lo", "hi", "country").collect()) == [
        (10 << 24, (11 << 24) - 1, "AA"),
        ((192 << 24) + (168 << 16) + (1 << 8) + 128, (192 << 24) + (168 << 16) + (1 << 8) + 255, "BB"),
    ]


NETS6 = [
    "2001:db8::/32", "2a00:1450::/29", "fe80::/10", "2600::/48", "2600:0:1::/49", "2600:0:1:8000::/50",
    "2600:0:2::/64", "2600:0:3::/65", "2600:0:3:0:8000::/66", "2600:0:4::1/128", "8000::/17", "2600:0:5::/63",
]


def probes6():
    rng = random.Random(3)
    found = [ipaddress.IPv6Address(0), ipaddress.IPv6Address(2**128 - 1)]
    for net in map(ipaddress.ip_network, NETS6):
        ends = int(net[0]), int(net[-1])
        near = [e + d for e in ends for d in (-1, 0, 1)] + [rng.randint(*ends)]
        found += [ipaddress.IPv6Address(n) for n in near if 0 <= n < 2**128]
    return found


@pytest.mark.parametrize("form", ["broadcast", "shuffled", "salted"])
def test_ipv6_same_as_brute_force(spark, form):
    nets = spark.createDataFrame([(n,) for n in [*NETS6, "10.0.0.0/8", "x"]], "country string")
    six = cidr_blocks6(nets, "country").select("net_hi", "net_lo", "prefix", "country")
    assert six.count() == len(NETS6)
    four = spark.createDataFrame([(1 << 24, (1 << 24) + 99, "four")], "lo bigint, hi bigint, country string")
    cut = geo_blocks(four, blocks6=six, **({} if form == "broadcast" else {"broadcast_bytes": 0}))
    want = {}
    for address in probes6():
        inside = [n for n in NETS6 if address in ipaddress.ip_network(n)]
        for text_ in {str(address), address.exploded, str(address).upper()}:
            want[text_] = inside[0] if inside else None
    want |= {"::ffff:1.0.0.7": "four", "::FFFF:100:63": "four", "::ffff:1.0.0.100": None, "1.0.0.9": "four"}
    want |= {"2001:db8::1::": None, "2001:db8": None, ":::": None, "2600::12345": None, "fe80::1%eth0": None}
    rows = spark.createDataFrame([(t,) for t in want], "request_ip string")
    found = ip_to_country(rows, cut, hot=salts_for(rows, cut) if form == "salted" else None)
    assert {r["request_ip"]: r["country"] for r in found.collect()} == want
    assert found.count() == len(want)
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("prefix", ["2001::/20", "2600::/66"])
def test_one_prefix_with_two_countries_is_refused(spark, prefix):
    nets = spark.createDataFrame([(prefix, "a"), (prefix, "b")], "network string, country string")
    four = spark.createDataFrame([], "lo bigint, hi bigint, country string")
    with pytest.raises(ValueError, match="overlap"):
        geo_blocks(four, blocks6=cidr_blocks6(nets))
