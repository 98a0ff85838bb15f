"""Times as Columns; ranges are half-open."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR = 3_600_000_000


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a time without zone."""
    return F.unix_micros(ts.cast("timestamp"))


def acquired(date: Column, hhmm: Column) -> Column:
    """A day and a number such as 730 (07:30) as a time."""
    return F.to_timestamp_ntz(F.concat_ws(" ", date, F.lpad(hhmm.cast("string"), 4, "0")), F.lit("yyyy-MM-dd HHmm"))


def day_minute(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def local_time(ts: Column, lon: Column) -> Column:
    """Solar time by longitude, to a quarter of an hour."""
    return ts + F.make_dt_interval(mins=(F.round(lon / 15 * 4) * 15).cast("int"))


def daytime(local: Column) -> Column:
    """1 from ten to before five in the afternoon, else 0; null stays null."""
    return F.when(local.isNotNull(), F.hour(local).between(10, 16).cast("int"))
