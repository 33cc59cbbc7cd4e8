"""IPv4 text to number, and the networks a number lies in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text form of an IPv4 address.
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4_PATTERN = rf"^{OCTET}(?:\.{OCTET}){{3}}$"


def ipv4_octets(text: Column | str) -> Column:
    """The four octets as texts; NULL unless the text is exactly an address."""
    column = F.col(text) if isinstance(text, str) else text
    return F.when(column.rlike(IPV4_PATTERN), F.split(column, r"\."))


def octets_to_number(octets: Column | str) -> Column:
    """BIGINT 0 .. 2^32-1 of an octet array."""
    number = F.lit(0).cast("bigint")
    for at in range(4):
        number = number * 256 + F.get(octets, F.lit(at)).try_cast("bigint")
    return number


def network(address: Column | str, host_bits: int) -> Column:
    """Number of the aligned network with `host_bits` host bits."""
    return F.shiftright(address, host_bits)
