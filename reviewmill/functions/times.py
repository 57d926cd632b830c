"""Timestamp expressions. The session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewmill.functions.numbers import parse_number
from reviewmill.functions.text import _col

# Epoch numbers from this magnitude on are milliseconds.
MILLISECOND_MAGNITUDE = 100_000_000_000
# Seconds between year 1 and year 9999, the range a calendar date can hold.
MIN_EPOCH_SECONDS = -62_135_596_800
MAX_EPOCH_SECONDS = 253_402_300_799
_DAY = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
_CLOCK = r"[T ][0-9]{2}(?::[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,6})?)?)?"
_ISO = rf"(?U)^\s*({_DAY}(?:{_CLOCK}(?:[+-][0-9]{{2}}:[0-9]{{2}}|Z)?)?)\s*$"
_ISO_UTC = rf"(?U)^\s*({_DAY}{_CLOCK}(?:[+-]00:00|Z))\s*$"


def epoch_ms_to_time(c: Column | str) -> Column:
    """Milliseconds to a timestamp; the fraction of a second is dropped."""
    return F.timestamp_seconds((_col(c) / F.lit(1000)).cast("bigint"))


def date_text(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd")


def year_text(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy")


def month_text(c: Column | str, pattern: str = "yyyy-MM") -> Column:
    return F.date_format(_col(c), pattern)


def parse_timestamp(c: Column | str, number: Column | None = None) -> Column:
    """Epoch seconds or milliseconds, or ISO text (no offset means UTC).

    ``number`` is the parsed number of the same text, where the caller already
    has it as a column; it is looked at several times.
    """
    number = parse_number(c) if number is None else number
    seconds = number / F.when(F.abs(number) >= MILLISECOND_MAGNITUDE, F.lit(1000.0)).otherwise(F.lit(1.0))
    in_range = seconds.between(MIN_EPOCH_SECONDS, MAX_EPOCH_SECONDS)
    from_number = F.when(in_range, F.timestamp_micros(F.round(seconds * F.lit(1e6)).try_cast("bigint")))
    # The text of a number never has the form of an ISO time.
    return F.coalesce(from_number, F.regexp_extract(_col(c), _ISO, 1).try_cast("timestamp"))


def parse_utc(c: Column | str) -> Column:
    """Strict ISO time that states the UTC offset itself; null otherwise."""
    return F.regexp_extract(_col(c), _ISO_UTC, 1).try_cast("timestamp")
