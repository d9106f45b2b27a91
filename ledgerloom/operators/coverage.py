"""Key reconciliation, period coverage and rolling averages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import percent


def reconcile_keys(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Distinct key pairs that miss a side. Keys are de-duplicated before the join."""
    a = left.select(F.col(left_key).alias("left_key")).distinct()
    b = right.select(F.col(right_key).alias("right_key")).distinct()
    both = a.join(b, F.col("left_key") == F.col("right_key"), "full")
    return both.filter(F.col("left_key").isNull() | F.col("right_key").isNull()).distinct()


def coverage(df: DataFrame, key: str, period: str, name: str = "total_month") -> DataFrame:
    """Distinct periods per key."""
    return df.groupBy(key).agg(F.count_distinct(period).alias(name))


def cumulative_share(df: DataFrame, level: str, count: str, name: str) -> DataFrame:
    """Cumulative percent of `count` from the highest level down. One row per level."""
    running = F.sum(count).over(Window.orderBy(F.desc(level)))
    total = F.sum(count).over(Window.partitionBy())
    return df.withColumn(name, percent(running, total))


def rolling_avg(value: Column, order: str, n: int) -> Column:
    """Average of the current and n-1 earlier rows; the input has one row per period."""
    window = Window.orderBy(order).rowsBetween(1 - n, 0)
    return F.sum(value).over(window) / F.count(value).over(window)
