"""Visit funnels and attribution of events to campaigns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def funnel(
    events: DataFrame, visit: str, item: str, view: Column, add: Column, buy: Column
) -> DataFrame:
    """Views, adds, abandoned and purchased adds per item.

    An add counts as purchased when its visit holds a purchase. Events are merged
    per (visit, item) first, so a visit's window holds at most one row per item.
    """
    per_item = events.groupBy(visit, item).agg(
        F.count_if(view).alias("views"),
        F.count_if(add).alias("adds"),
        F.max(buy).alias("_buy"),
    )
    bought = F.max("_buy").over(Window.partitionBy(visit))
    flagged = per_item.withColumn("_bought", bought)
    return flagged.groupBy(item).agg(
        F.sum("views").alias("views"),
        F.sum("adds").alias("adds"),
        F.sum(F.when(~F.col("_bought"), F.col("adds")).otherwise(0)).alias("abandoned"),
        F.sum(F.when(F.col("_bought"), F.col("adds")).otherwise(0)).alias("purchased"),
    )


def attribute(
    events: DataFrame, campaigns: DataFrame, time: str, start: str, end: str, name: str
) -> DataFrame:
    """Each event with the name of each campaign whose closed window holds it, NULL for none.

    Campaigns are laid out by day, so the range join is an equi-join on the day
    with the exact bounds checked after; Spark broadcasts the campaign days if they
    are few and shuffles on the day if not.
    """
    days = F.sequence(F.col(start).cast("date"), F.col(end).cast("date"))
    valid = campaigns.filter(F.col(start) <= F.col(end)).select(name, start, end)
    by_day = valid.withColumn("_day", F.explode(days))
    on_day = F.col(time).cast("date") == F.col("_day")
    inside = F.col(time).between(F.col(start), F.col(end))
    return events.join(by_day, on_day & inside, "left").drop("_day", start, end)
