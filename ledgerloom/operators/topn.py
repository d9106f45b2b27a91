"""First per key, top n and membership filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Smallest `order` tuple of each key; an aggregate, so it combines map side."""
    first = F.min(F.struct(*order)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, *[f"_first.{c}" for c in order])


def leaders(df: DataFrame, keys: list[str], metric: str) -> DataFrame:
    """Rows whose metric is the highest of their key, all ties kept.

    Looked up by one struct, so NULL keys match and both sides read the same shuffle.
    """
    best = df.groupBy(*keys).agg(F.max(metric).alias(metric))
    key = F.struct(*keys, metric).alias("_key")
    return df.select("*", key).join(best.select(key), "_key", "left_semi").drop("_key")


def top_n(
    df: DataFrame, metric: str, n: int, tiebreak: list[str], ascending: bool = False
) -> DataFrame:
    """The n rows with the highest (or lowest) metric; ties cut by `tiebreak`.

    NULL is the lowest value.
    """
    key = F.asc_nulls_first(metric) if ascending else F.desc_nulls_last(metric)
    return df.orderBy(key, *tiebreak).limit(n)


def top_n_with_ties(
    df: DataFrame, metric: str, n: int, ascending: bool = False, name: str = "rn"
) -> DataFrame:
    """Rows with rank <= n over the whole table and their rank, ties kept.

    Spark finds the n extreme rows without a full sort; their distinct values (at
    most n) carry the ranks, and the join brings back every row that ties on them.
    """
    key = F.asc(metric) if ascending else F.desc(metric)
    extreme = df.select(metric).filter(F.col(metric).isNotNull()).orderBy(key).limit(n)
    counted = extreme.groupBy(metric).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    ranked = counted.select(
        metric, (F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1).cast("int").alias(name)
    )
    return df.join(F.broadcast(ranked), metric).select(*df.columns, name)


def not_in(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """SQL `key NOT IN (SELECT other_key ...)`.

    One NULL in the list empties the result, and a NULL key only passes an empty
    list. The NULL test is a scalar subquery, so a large list is never broadcast.
    """
    values = other.select(F.col(other_key).alias(key))
    counts = values.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col(key).isNull()).alias("nulls"),
        ).alias("c")
    ).scalar()
    usable = (counts["n"] == 0) | ((counts["nulls"] == 0) & F.col(key).isNotNull())
    return df.join(values, key, "left_anti").filter(usable)
