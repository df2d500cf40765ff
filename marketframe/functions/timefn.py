"""Time functions: bucketing, epoch conversion, ISO parsing, interval arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def minute_start(ts) -> Column:
    """F1 toStartOfMinute."""
    return F.date_trunc("minute", _c(ts))


def bucket_start(ts, seconds: int) -> Column:
    """F2 toStartOfInterval(ts, INTERVAL n SECOND): epoch-aligned bucket start."""
    us = int(seconds) * 1_000_000
    return F.timestamp_micros(F.floor(F.unix_micros(_c(ts)) / F.lit(us)).cast("long") * F.lit(us))


def parse_iso_utc(s) -> Column:
    """F6/F10 ISO-8601 text (with or without offset) → UTC timestamp, NULL when unparseable."""
    s = _c(s)
    return F.coalesce(
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")),
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSXXX")),
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSS")),
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss")),
    )


def format_iso(ts) -> Column:
    """ISO-8601 with microseconds and a +00:00 offset, as the feed writes it."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def seconds_between(later, earlier) -> Column:
    """F9 (later - earlier) in fractional seconds."""
    return (F.unix_micros(_c(later)) - F.unix_micros(_c(earlier))) / F.lit(1e6)


def plus_hours(ts, hours) -> Column:
    """F8 ts + INTERVAL <column> HOUR, column-valued."""
    return _c(ts) + F.make_dt_interval(F.lit(0), _c(hours).cast("int"))
