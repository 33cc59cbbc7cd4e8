"""Bounce categories and the hard / soft / other classes they fall into."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bounce categories by class.
HARD_BOUNCES = ("bad-mailbox", "inactive-mailbox")
SOFT_BOUNCES = ("policy-related", "quota-issues")


def in_list(column: Column | str, values: tuple[str, ...]) -> Column:
    """Membership test; NULL for a NULL value, as in SQL."""
    column = F.col(column) if isinstance(column, str) else column
    return column.isin(*values)


def classify_bounce(category: Column | str) -> Column:
    """`hard`, `soft` or `other`; a missing or unknown category is `other`."""
    return (
        F.when(in_list(category, HARD_BOUNCES), "hard")
        .when(in_list(category, SOFT_BOUNCES), "soft")
        .otherwise("other")
    )
