"""Identifier normalisation.

A connector may send the same id as ``123``, ``"123.000000000"`` or ``1.23E5``. A 64-bit
integer cast rejects the last two under ANSI rules, and a double loses the low digits of
18-digit ids, so ids go through ``decimal(38,0)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ID_NUMBER = "decimal(38,0)"


def id_number(col: Column | str) -> Column:
    """The id as an exact integer; NULL when the text is not a number."""
    return _c(col).try_cast(ID_NUMBER)


def normalize_id(col: Column | str, strict: bool = False) -> Column:
    """The id as an integer-like string. ``strict`` raises on text that is not a number."""
    number = _c(col).cast(ID_NUMBER) if strict else id_number(col)
    return number.cast("string")


def has_raw_format(col: Column | str) -> Column:
    """True when the id text still has a decimal point or an exponent."""
    return _c(col).contains(".") | _c(col).rlike("[eE]")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
