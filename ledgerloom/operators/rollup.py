"""Aggregates that are taken once and rolled up: distinct counts as bitmaps, totals of many dimensions at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_states(df: DataFrame, period: str, number: str) -> DataFrame:
    """(period, bucket, bits): the numbers (whole, from 0 on) seen in each period, as exact bitmaps.

    A bucket holds 32,768 neighbouring numbers. States of any periods can be merged, so they may be stored by
    day and only new days added.
    """
    bucket, place = F.bitmap_bucket_number(number), F.bitmap_bit_position(number)
    known = df.where(F.col(number).isNotNull())
    seen = known.withColumn("_place", place).groupBy(F.col(period), bucket.alias("bucket"))
    return seen.agg(F.bitmap_construct_agg("_place").alias("bits"))


def distinct_counts(states: DataFrame, periods: dict[str, Column], name: str) -> DataFrame:
    """(kind, start, `name`): distinct numbers per longer period, for all kinds of periods from one reading."""
    kinds = [F.struct(F.lit(kind).alias("kind"), start.alias("start")) for kind, start in periods.items()]
    each = states.select("bucket", "bits", F.inline(F.array(*kinds)))
    merged = each.groupBy("kind", "start", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy("kind", "start").agg(F.sum(F.bitmap_count("bits")).alias(name))


def by_each(df: DataFrame, dims: list[str], aggregates: list[Column]) -> DataFrame:
    """(grouping_id, dim, area, ...): the aggregates by each dimension, from one reading and one shuffle."""
    sets = [[F.col(d)] for d in dims]
    all_ = df.groupingSets(sets, *dims).agg(F.grouping_id().alias("grouping_id"), *aggregates)
    # a dimension's bit is 0 in its own sets; its value may be NULL there as well
    bits = {d: (1 << len(dims)) - 1 - (1 << (len(dims) - 1 - i)) for i, d in enumerate(dims)}
    chosen = lambda of: F.coalesce(*[F.when(F.col("grouping_id") == bits[d], of(d)) for d in dims])
    named = all_.select(
        F.col("grouping_id").cast("int").alias("grouping_id"), chosen(F.lit).alias("dim"), chosen(F.col).alias("area"),
        *[c for c in all_.columns if c not in (*dims, "grouping_id")],
    )
    return named
