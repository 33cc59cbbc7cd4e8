"""Address blocks from CSV files: one of CIDR networks, one of countries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailstream.functions.ipv4 import ipv4_octets, octets_to_number
from mailstream.functions.ipv6 import high_half, ipv6_groups, low_half

# Columns of the two files.
NETWORK = "network"
PLACE = "geoname_id"
COUNTRY = "country_iso_code"


def cidr_blocks(networks: DataFrame, network: str = NETWORK) -> DataFrame:
    """Add `lo` and `hi` for an IPv4 network text like `10.0.0.0/8`.

    Networks of the other address family, or malformed ones, are left out.
    """
    parts = networks.withColumn("__parts", F.split(network, "/"))
    octets = parts.withColumn("__octets", ipv4_octets(F.get("__parts", F.lit(0))))
    bits = 32 - F.get("__parts", F.lit(1)).try_cast("int")
    ranged = octets.withColumns({"lo": octets_to_number("__octets"), "__bits": bits})
    valid = ranged.where("lo is not null and __bits between 0 and 32")
    size = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("__bits"))
    return valid.withColumn("hi", F.col("lo") + size - 1).drop("__parts", "__octets", "__bits")


def cidr_blocks6(networks: DataFrame, network: str = NETWORK) -> DataFrame:
    """Add `net_hi`, `net_lo` and `prefix` for an IPv6 network text like `2001:db8::/32`.

    Networks of the other address family, or malformed ones, are left out.
    """
    parts = networks.withColumn("__parts", F.split(network, "/"))
    groups = parts.withColumn("__groups", ipv6_groups(F.get("__parts", F.lit(0))))
    ranged = groups.withColumns(
        {
            "net_hi": high_half(F.col("__groups")),
            "net_lo": low_half(F.col("__groups")),
            "prefix": F.get("__parts", F.lit(1)).try_cast("int"),
        }
    )
    valid = ranged.where("net_hi is not null and prefix between 0 and 128")
    return valid.drop("__parts", "__groups")


def _with_country(
    spark: SparkSession, networks: str, places: str
) -> tuple[DataFrame, DataFrame]:
    networks_csv = spark.read.option("header", "true").csv(networks)
    places_csv = spark.read.option("header", "true").csv(places)
    named = places_csv.select(PLACE, F.col(COUNTRY).alias("country"))
    return networks_csv.select(NETWORK, PLACE), named.where("country is not null")


def read_geo_blocks(spark: SparkSession, networks: str, places: str) -> DataFrame:
    """`(lo, hi, country)` of the IPv4 networks of a networks file and a places file.

    Both files have headers.  Networks without a country are kept out, so their
    addresses have none.
    """
    nets, named = _with_country(spark, networks, places)
    return cidr_blocks(nets).join(named, PLACE).select("lo", "hi", "country")


def read_geo_blocks6(spark: SparkSession, networks: str, places: str) -> DataFrame:
    """`(net_hi, net_lo, prefix, country)` of the IPv6 networks of the same files."""
    nets, named = _with_country(spark, networks, places)
    return cidr_blocks6(nets).join(named, PLACE).select("net_hi", "net_lo", "prefix", "country")
