"""IPv6 text to two numbers of 64 bits, and the networks they lie in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailstream.functions.ipv4 import OCTET

# The text forms of an IPv6 address, in small letters.
GROUP = "[0-9a-f]{1,4}"
GROUPS = rf"(?:{GROUP}(?::{GROUP})*)?"
IPV6_PATTERN = rf"^(?:{GROUP}(?::{GROUP}){{7}}|{GROUPS}::{GROUPS})$"
DOTTED_PATTERN = rf"^([0-9a-f:]*:)({OCTET}(?:\.{OCTET}){{3}})$"
MAPPED = 0xFFFF


def _dotted_as_groups(text: Column) -> Column:
    """A dotted IPv4 ending written as two groups."""
    octets = F.split(F.regexp_extract(text, DOTTED_PATTERN, 2), r"\.")

    def group(at: int) -> Column:
        high, low = (F.get(octets, F.lit(k)).try_cast("bigint") for k in (at, at + 1))
        return F.lower(F.hex(high * 256 + low))

    whole = F.concat(F.regexp_extract(text, DOTTED_PATTERN, 1), group(0), F.lit(":"), group(2))
    return F.when(text.rlike(DOTTED_PATTERN), whole).otherwise(text)


def ipv6_groups(text: Column | str) -> Column:
    """The eight groups as numbers; NULL unless the text is exactly an address."""
    column = F.lower(F.col(text) if isinstance(text, str) else text)
    plain = F.when(column.contains("."), _dotted_as_groups(column)).otherwise(column)
    sides = F.split(plain, "::", 2)

    def groups(side: Column) -> Column:
        none = F.array().cast("array<string>")
        return F.when(F.coalesce(side, F.lit("")) == "", none).otherwise(F.split(side, ":"))

    head, tail = groups(F.get(sides, F.lit(0))), groups(F.get(sides, F.lit(1)))
    missing = F.lit(8) - F.size(head) - F.size(tail)
    filled = F.concat(head, F.array_repeat(F.lit("0"), missing), tail)
    # `::` stands for one group at least.
    whole = plain.rlike(IPV6_PATTERN) & F.when(F.size(sides) == 1, missing == 0).otherwise(
        missing > 0
    )
    numbers = F.transform(filled, lambda g: F.conv(g, 16, 10).try_cast("bigint"))
    return F.when(F.instr(column, ":") > 0, F.when(whole, numbers))


def _joined(groups: Column, first: int, count: int) -> Column:
    number = F.lit(0).cast("bigint")
    for at in range(first, first + count):
        number = F.shiftleft(number, 16).bitwiseOR(F.get(groups, F.lit(at)))
    return number


def mapped_ipv4(groups: Column) -> Column:
    """The IPv4 number of an address that stands for one, else NULL."""
    zero = F.lit(True)
    for at in range(5):
        zero = zero & (F.get(groups, F.lit(at)) == 0)
    is_mapped = zero & (F.get(groups, F.lit(5)) == MAPPED)
    return F.when(is_mapped, _joined(groups, 6, 2))


def high_half(groups: Column) -> Column:
    """The first 64 bits, as a BIGINT whose sign is the first bit."""
    return _joined(groups, 0, 4)


def low_half(groups: Column) -> Column:
    """The last 64 bits, likewise."""
    return _joined(groups, 4, 4)
