"""Shares, before/after, cohorts, buckets and period ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import int_div, percent, ratio


def share_of_total(
    df: DataFrame, group: list[str], value: str, shares: dict[str, Column], digits: int = 2
) -> DataFrame:
    """Percent of the group's total that falls under each condition; NULL if none does."""
    parts = [F.sum(F.when(test, F.col(value))).alias(name) for name, test in shares.items()]
    sums = df.groupBy(*group).agg(F.sum(value).alias("_total"), *parts)
    return sums.select(
        *group, *[percent(F.col(n), F.col("_total"), digits).alias(n) for n in shares]
    )


def before_after(
    df: DataFrame, dims: list[str], value: str, before: Column, after: Column
) -> DataFrame:
    """Sums before and after a pivot by dimension, in one pass; NULL where no row falls."""
    return df.groupBy(*dims).agg(
        F.sum(F.when(before, F.col(value))).alias("before"),
        F.sum(F.when(after, F.col(value))).alias("after"),
    )


def change_percent() -> Column:
    """(after - before) / before in percent."""
    return percent(F.col("after") - F.col("before"), F.col("before"))


def histogram(df: DataFrame, value: str, width: int) -> DataFrame:
    """Rows per bucket of fixed width with a 'low-high' label, ordered by bucket."""
    low = int_div(F.col(value), F.lit(width)) * width
    counted = df.groupBy(low.alias("_low")).agg(F.count(F.lit(1)).alias("frequency"))
    label = F.concat(F.col("_low").cast("string"), F.lit("-"), (F.col("_low") + width).cast("string"))
    return counted.orderBy("_low").select("frequency", label.alias("day_range"))


def period_ratio(df: DataFrame, period: str, metric: str, name: str) -> DataFrame:
    """Metric over that of the previous row; 0 for the first. One row per period."""
    previous = F.lag(metric).over(Window.orderBy(period))
    return df.select(
        period,
        F.coalesce(ratio(F.col(metric), previous, 2), F.lit(0).cast("decimal(18,2)")).alias(name),
    )


def cohort_compare(
    df: DataFrame, labels: dict[str, Column], metrics: dict[str, Column], name: str
) -> DataFrame:
    """One row per cohort: each metric aggregated over the rows the cohort's test keeps.

    `metrics` maps a name to a function of the test that gives an aggregate; all
    cohorts come from one pass.
    """
    cells = [
        F.struct(
            F.lit(label).alias(name), *[make(test).alias(m) for m, make in metrics.items()]
        )
        for label, test in labels.items()
    ]
    return df.agg(F.array(*cells).alias("_rows")).select(F.inline("_rows"))
