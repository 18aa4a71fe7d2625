"""Epoch milliseconds and the text form of timestamps used on the wire. Sessions run in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text form of timestamps in merged messages and load times.
TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"


# Milliseconds of the years 1 to 9999, which the text form can hold.
FIRST_MILLIS, LAST_MILLIS = -62_135_596_800_000, 253_402_300_799_999


def from_millis(millis: Column) -> Column:
    """Timestamp floored to the second; null outside the years 1 to 9999."""
    known = millis.between(FIRST_MILLIS, LAST_MILLIS)
    return F.when(known, F.date_trunc("second", F.timestamp_millis(F.when(known, millis))))


def to_text(ts: Column) -> Column:
    return F.date_format(ts, TEXT_FORMAT)


def from_text(text: Column) -> Column:
    """Null for text that does not follow the format."""
    return F.try_to_timestamp(text, F.lit(TEXT_FORMAT))


def load_time() -> Column:
    return to_text(F.current_timestamp())


def calendar(ts: Column) -> dict[str, Column]:
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "quarter": F.quarter(ts),
    }
