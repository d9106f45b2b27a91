"""State of an entity over dated rows (one row per state, a handful per entity)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def next_state(
    df: DataFrame, key: str, order: list[str], value: str, name: str
) -> DataFrame:
    """Add the value of the entity's next row."""
    return df.withColumn(name, F.lead(value).over(Window.partitionBy(key).orderBy(*order)))


def state_at(
    df: DataFrame, key: str, date: str, state: str, as_of: Column, as_written: bool = True
) -> DataFrame:
    """(key, state) that holds at `as_of`.

    As written a state that starts on the day itself is lost, because its start
    must lie before the day; `as_written=False` counts it.
    """
    known = df.filter(F.col(date) <= as_of)
    dated = next_state(known, key, [date, state], date, "_next")
    if as_written:
        started = F.col(date) < as_of
        current = dated.filter(started & (F.col("_next").isNull() | (F.col("_next") >= as_of)))
    else:
        current = dated.filter(F.col("_next").isNull())
    return current.select(key, state).distinct()


def billing_schedule(
    df: DataFrame,
    keys: list[str],
    start: Column,
    end: Column,
    repeats: Column,
    name: str = "payment_date",
) -> DataFrame:
    """One row per payment: at `start`, then monthly while more than a month is left.

    Each step adds a month to the previous payment, so a day cut at a short month
    stays cut (31 Jan, 29 Feb, 29 Mar). The n-th payment is worked out from n: its month,
    and the day cut to the shortest month since the start. Only days after the 28th are ever cut; for
    these the lengths of two years of months, which hold every length there is, are listed once per start.
    """
    limit = F.add_months(end, -1)
    steps = F.greatest(F.ceil(F.months_between(limit, start)).cast("int") + 1, F.lit(0))
    months = F.sequence(F.lit(0), F.when(repeats, steps).otherwise(F.lit(0)))
    first = F.trunc(start, "MM")
    lengths = F.transform(
        F.sequence(F.lit(0), F.lit(24)), lambda j: F.dayofmonth(F.last_day(F.add_months(first, j)))
    )
    late = F.when(F.dayofmonth(start) > 28, lengths)

    def payment(n: Column) -> Column:
        shortest = F.array_min(F.slice("_lengths", 1, F.least(n, F.lit(24)) + 1))
        day = F.least(F.dayofmonth("_start"), shortest)
        cut = F.date_add(F.add_months(F.trunc("_start", "MM"), n), day - 1)
        return F.when(F.col("_lengths").isNull(), F.add_months("_start", n)).otherwise(cut)

    n = F.col("_n")
    due = df.select(
        *keys, start.alias("_start"), limit.alias("_limit"), late.alias("_lengths"), F.explode(months).alias("_n")
    )
    due = due.filter((n == 0) | (payment(F.greatest(n - 1, F.lit(0))) < F.col("_limit")))
    return due.select(*keys, payment(n).alias(name))
