"""Flags and derived columns of one call record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PEAK_HOURS = (17, 21)  # inclusive: 17:00 to 21:59
WEEKEND_DAYS = (1, 7)  # Sunday, Saturday


def peak_flag(ts: Column) -> Column:
    """True for calls in the evening peak, 17:00 up to and including 21:59."""
    return F.hour(ts).between(*PEAK_HOURS)


def weekend_flag(ts: Column) -> Column:
    """True on Saturday and Sunday."""
    return F.dayofweek(ts).isin(*WEEKEND_DAYS)


def is_international(call_type: Column, destination: Column, home_prefix: str = "+1") -> Column:
    """A voice call to a ``+`` number outside the home prefix."""
    return (
        (call_type == "VOICE")
        & destination.startswith("+")
        & ~destination.startswith(home_prefix)
    )


def is_promo(code: Column) -> Column:
    """True for a promotion code other than NONE; null code → null."""
    return code != "NONE"


def call_date_parts(ts: Column) -> dict[str, Column]:
    """The calendar columns of the cleaned table."""
    day = F.to_date(ts)
    return {
        "call_date": day,
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "hour": F.hour(ts),
    }


def month_index(ts: Column) -> Column:
    """Months since year 0, so that month frames are plain integer ranges."""
    return F.year(ts) * 12 + F.month(ts)


def created_timestamp(ts: Column) -> Column:
    """Creation time of a feature row: the newest record that went into it."""
    return ts
