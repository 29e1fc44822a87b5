"""Times, all in UTC (the session's time zone must be so)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WATCHLIST_FORMAT = "dd-MMM-yyyy HH:mm:ss"


def watchlist_time(text: Column) -> Column:
    """Text such as 05-Jan-2026 10:00:00 as a timestamp; null if it has another form. Month names may be in any case."""
    return F.try_to_timestamp(text, F.lit(WATCHLIST_FORMAT))


def iso_date(text: Column) -> Column:
    """yyyy-MM-dd as a date; null if it has another form."""
    return F.try_to_date(text, "yyyy-MM-dd")


def iso_seconds(ts: Column) -> Column:
    """ISO-8601 text to the second, with a Z."""
    return F.date_format(F.date_trunc("second", ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def parse_iso(text: Column) -> Column:
    return F.try_to_timestamp(text)


def minutes_between(a: Column, b: Column) -> Column:
    """Minutes, without sign, to the microsecond."""
    return F.abs(F.unix_micros(a) - F.unix_micros(b)) / 60_000_000
