"""Calendar helpers: numeric dates, the open-date sentinel, caller-supplied clock."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: this date stands for "none" in every date column.
OPEN_DATE = "0001-01-01"


def open_date() -> Column:
    return F.lit(OPEN_DATE).cast("date")


def date8(day: Column) -> Column:
    """Date as the integer yyyymmdd."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def date8_or_zero(day: Column) -> Column:
    """Like date8, with 0 for NULL and for the open-date sentinel."""
    return F.when(day.isNull() | (day == open_date()), 0).otherwise(date8(day)).cast("int")


def is_open(day: Column) -> Column:
    return day == open_date()


def age_in_years(birth: Column, as_of: date) -> Column:
    """Difference of calendar years, whether or not the birthday has passed."""
    return F.lit(as_of.year) - F.year(birth)


def on_day(stamp: Column, day: date) -> Column:
    """date(stamp) = day as a half-open range, so that it reaches the Parquet reader."""
    return (stamp >= clock(datetime.combine(day, datetime.min.time()))) & (
        stamp < clock(datetime.combine(day + timedelta(days=1), datetime.min.time()))
    )


def clock(as_of: datetime | None = None) -> Column:
    """The row-change stamp: a literal when the caller fixes it, else the current time."""
    now = F.current_timestamp() if as_of is None else F.lit(as_of.isoformat(" "))
    return now.cast("timestamp_ntz")
