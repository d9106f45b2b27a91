"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import int_div


def us_week(day: Column) -> Column:
    """Week of the year: week 1 holds 1 January, weeks start on Sunday."""
    first_weekday = F.dayofweek(F.trunc(day, "year"))
    return (int_div(F.dayofyear(day) + first_weekday - 2, F.lit(7)) + 1).cast("int")


def minute_part(start: Column, end: Column) -> Column:
    """Minute component (0-59) of the time from start to end."""
    seconds = F.timestamp_diff("SECOND", start, end)
    return F.pmod(F.floor(seconds / 60), F.lit(60)).cast("int")


def short_date(text: Column) -> Column:
    """Day/month/two-digit-year text to a date; 00-49 is 20xx, 50-99 is 19xx."""
    day = F.to_date(text, "d/M/yy")
    return F.when(F.year(day) > 2049, F.add_months(day, -1200)).otherwise(day)


def month_start(text: Column) -> Column:
    """Month-year text (MM-yyyy) to the first day of that month."""
    month, year = (F.substring_index(text, "-", side).cast("int") for side in (1, -1))
    return F.make_date(year, month, F.lit(1))
