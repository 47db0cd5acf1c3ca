"""Times as zone-free UTC wall clocks, with Pacific wall clocks beside them.

Spark has no timestamp that keeps its own offset. Everything here is TIMESTAMP_NTZ in UTC,
so no result depends on the session's time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PACIFIC = "America/Los_Angeles"


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def from_seconds(col: Column) -> Column:
    return F.timestamp_add("SECOND", col.cast("bigint"), _epoch())


def from_millis(col: Column) -> Column:
    return F.timestamp_add("MICROSECOND", col.cast("bigint") * 1000, _epoch())


def from_epoch(col: Column, unit: str) -> Column:
    """An epoch number as a UTC wall clock; ``unit`` is ``s`` or ``ms``."""
    return {"s": from_seconds, "ms": from_millis}[unit](col)


def to_seconds(ntz: Column) -> Column:
    # Whole seconds of a zone-free time, without its calendar; both count towards zero.
    return F.unix_timestamp(ntz)


def to_millis(ntz: Column) -> Column:
    """Whole seconds since the epoch, times 1000."""
    return to_seconds(ntz) * 1000


def exact_millis(ntz: Column) -> Column:
    """Milliseconds since the epoch, rounded down: the inverse of :func:`from_millis`."""
    return F.floor(micros(ntz).cast("decimal(20,0)") / 1000).cast("bigint")


def micros(ntz: Column) -> Column:
    """Microseconds since the epoch: a time as a whole number, of which files keep statistics."""
    return F.timestamp_diff("MICROSECOND", _epoch(), ntz)


def from_micros(col: Column) -> Column:
    return F.timestamp_add("MICROSECOND", col, _epoch())


def to_pacific(ntz: Column) -> Column:
    """The Pacific wall clock of a UTC wall clock, daylight saving included.

    Goes through the instant, because ``convert_timezone`` looks both zones up for every row and
    costs twice as much; neither step depends on the session's zone.
    """
    instant = F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch(), ntz))
    shifted = F.unix_micros(F.from_utc_timestamp(instant, PACIFIC))
    return F.timestamp_add("MICROSECOND", shifted, _epoch())


def pacific_date(ntz: Column) -> Column:
    return F.to_date(to_pacific(ntz))


def day(ntz: Column) -> Column:
    """The day of ``ntz`` as a wall clock at midnight."""
    return F.to_date(ntz).cast("timestamp_ntz")


def as_utc(df: DataFrame, *names: str) -> DataFrame:
    """Turn TIMESTAMP columns (instants) into UTC wall clocks; NTZ columns stay as they are."""
    instants = {
        n: F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(n).cast("timestamp_ntz"))
        for n in names
        if n in df.columns and isinstance(df.schema[n].dataType, T.TimestampType)
    }
    return df.withColumns(instants) if instants else df
