"""Dates, times and counts as text: Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STAMP = r"\[(\d{2}):(\d{2}):(\d{2})\]"
LOOSE_STAMP = r"\[(\d+):(\d{2}):(\d{2})\]"


def _whole(c: Column, kind: str = "bigint") -> Column:
    return c.try_cast(kind)


def epoch_to_timestamp(seconds: Column) -> Column:
    """Seconds since 1970 as a timestamp; it shows in the session's zone, which should be UTC."""
    return F.timestamp_seconds(seconds)


def epoch_text(seconds: Column, zone: str = "UTC", pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """The wall clock of a zone at that second (the session's zone must be UTC)."""
    return F.date_format(F.from_utc_timestamp(F.timestamp_seconds(seconds), zone), pattern)


def stamp_seconds(stamp: Column) -> Column:
    """HH:MM:SS to seconds; null where a part is no number."""
    parts = F.split(stamp, ":")
    return _whole(F.get(parts, F.lit(0))) * 3600 + _whole(F.get(parts, F.lit(1))) * 60 + _whole(F.get(parts, F.lit(2)))


def _parts(seconds: Column) -> tuple[Column, Column, Column]:
    s = seconds.cast("long")
    return F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60


def ms_clock(ms: Column) -> Column:
    """Milliseconds to HH:MM:SS, truncated; hours grow beyond two digits."""
    return F.format_string("%02d:%02d:%02d", *_parts(F.floor(ms / 1000)))


def seconds_clock(seconds: Column) -> Column:
    """Seconds to H:MM:SS."""
    return F.format_string("%d:%02d:%02d", *_parts(F.floor(seconds)))


def span_clock(seconds: Column) -> Column:
    """Seconds to H:MM:SS; from 24 hours on `1 day, H:MM:SS` or `2 days, H:MM:SS`."""
    whole = F.floor(seconds).cast("long")
    days, rest = F.floor(whole / 86_400), seconds_clock(whole % 86_400)
    return F.when(days == 0, rest).otherwise(F.concat(days.cast("string"), F.when(days == 1, F.lit(" day, ")).otherwise(F.lit(" days, ")), rest))


def length_seconds(text: Column) -> Column:
    """mm:ss or hh:mm:ss to seconds; anything else, null included, is 0."""
    parts = F.split(text, ":")
    at = [_whole(F.get(parts, F.lit(i))) for i in range(3)]
    made = F.when(F.size(parts) == 2, at[0] * 60 + at[1]).when(F.size(parts) == 3, at[0] * 3600 + at[1] * 60 + at[2])
    return F.coalesce(made, F.lit(0).cast("long"))


def relative_date(text: Column, now: Column) -> Column:
    """`3 weeks ago` to the date then; months have 30 days and years 365; anything else is the date of now."""
    pattern = r"(\d+)\s*(hour|day|week|month|year)s?\s*ago"
    number, unit = _whole(F.regexp_extract(F.lower(text), pattern, 1), "int"), F.regexp_extract(F.lower(text), pattern, 2)
    hours = F.when(unit == "hour", 1).when(unit == "day", 24).when(unit == "week", 168).when(unit == "month", 720).when(unit == "year", 8760)
    return F.to_date(F.coalesce(now - F.make_dt_interval(F.lit(0), number * hours), now))


def time_name(ts: Column) -> Column:
    """A timestamp as part of a file's name."""
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def short_count(text: Column) -> Column:
    """`2.19M subscribers` to 2190000, in decimals and truncated; what is no count is 0."""
    number = F.regexp_extract(text, r"^\s*([0-9]+(?:\.[0-9]+)?)\s*([KMBkmb]?)", 1).try_cast("decimal(20,6)")
    unit = F.upper(F.regexp_extract(text, r"^\s*([0-9]+(?:\.[0-9]+)?)\s*([KMBkmb]?)", 2))
    factor = F.when(unit == "K", 1_000).when(unit == "M", 1_000_000).when(unit == "B", 1_000_000_000).otherwise(1)
    return F.coalesce(F.floor(number * factor).cast("long"), F.lit(0).cast("long"))


def digits_count(text: Column) -> Column:
    """`7,138 views` to 7138; no digits is 0."""
    return F.coalesce(_whole(F.regexp_replace(text, "[^0-9]", "")), F.lit(0).cast("long"))


def line_seconds(line: Column, strict_hours: bool = True) -> Column:
    """Seconds of the first [HH:MM:SS] in a line; null without one. strict_hours: two digits for the hours."""
    pattern = STAMP if strict_hours else LOOSE_STAMP
    parts = [_whole(F.regexp_extract(line, pattern, i)) for i in (1, 2, 3)]
    return F.when(line.rlike(pattern), parts[0] * 3600 + parts[1] * 60 + parts[2])
