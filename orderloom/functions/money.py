"""Money arithmetic.

Spark casts a double to decimal from its shortest decimal text, half up, so 1.005 becomes
1.01. Amounts are cast before they are summed, which keeps sums independent of row order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,2)"


def to_money(col: Column) -> Column:
    return col.cast(MONEY)


def from_cents(cents: Column) -> Column:
    """Whole cents as money. Integer arithmetic on cents is exact and much cheaper than decimals."""
    return (cents.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(MONEY)


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """The quotient, NULL for a zero denominator."""
    return numerator / F.nullif(denominator, F.lit(0).cast("double"))


def reversal(col: Column) -> Column:
    """The amount that takes ``col`` back: never positive, NULL counts as zero.

    Adding 0.0 turns the negative zero of a zero amount into plain zero.
    """
    return F.lit(0.0) - F.abs(F.coalesce(col, F.lit(0.0))) + F.lit(0.0)


def nonzero(col: Column) -> Column:
    return col.isNotNull() & (col != 0)
