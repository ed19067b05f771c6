"""Timestamps, date keys and lookback arithmetic."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, functions as F

from tidemark.schemas import EPOCH, OPEN_END


def ntz(value: datetime | str) -> Column:
    """A zone-less timestamp literal."""
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def open_end() -> Column:
    return ntz(OPEN_END)


def date_key(day: Column | str) -> Column:
    """YYYYMMDD as an integer."""
    return F.date_format(day, "yyyyMMdd").cast("int")


def month_key(ts: Column | str) -> Column:
    """YYYYMM as an integer, the partition value of a monthly table."""
    return F.date_format(ts, "yyyyMM").cast("int")


def micro_text(ts: Column | str) -> Column:
    """Timestamp text with exactly six fractional digits."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def micros(ts: Column | str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp") if isinstance(ts, str) else ts.cast("timestamp"))


def hours_between(later: Column, earlier: Column) -> Column:
    """Elapsed hours as a double."""
    return (micros(later) - micros(earlier)) / F.lit(3_600_000_000.0)


def effective_mark(mark: datetime, lookback: timedelta | None) -> datetime:
    """The mark moved back by the lookback, never before the epoch. A mark still at
    the epoch stays there."""
    if not lookback or mark <= EPOCH:
        return mark
    return max(EPOCH, mark - lookback)
