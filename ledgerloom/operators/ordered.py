"""Ordered work on keys that may hold a large part of all rows.

A plain window sends all rows of a key to one task. Here the rows of a key are cut into blocks along their order, each
block is worked on by itself, and only what crosses a border is exchanged: the last value of a block, the count of a
block, or the few rows next to a border. Results equal the plain window's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import int_div
from .positions import count_before
from .sharing import read_alike

# Rows of a page in `framed`.
PAGE = 100_000
# Blocks of a key that a quantile sketch gives, and how many of them make a coarse one.
BLOCKS = 1024
COARSE = 32


def carry_last(
    df: DataFrame, keys: list[str], block: Column, order: list[str], value: str, name: str
) -> DataFrame:
    """Add `name`: the last value that is not null among the rows of the same keys that sort before.

    No two rows with a value agree on keys and order; the block ascends with the order.
    """
    keyed = df.withColumn("_leaf", F.struct(*keys, block.alias("_block")))
    earlier = Window.partitionBy("_leaf").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # Both readers below take the rows of the window's shuffle.
    inside = read_alike(keyed.withColumn(name, F.last(value, ignorenulls=True).over(earlier)))
    place = F.when(F.col(value).isNotNull(), F.struct(*order))
    ends = inside.groupBy("_leaf").agg(F.max_by(value, place).alias("_end"))
    blocks = Window.partitionBy(*[f"_leaf.{k}" for k in keys]).orderBy("_leaf._block")
    before = blocks.rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_leaf", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    joined = inside.join(carried, "_leaf")
    return joined.withColumn(name, F.coalesce(name, "_carried")).drop("_leaf", "_carried")


def as_of(
    rows: DataFrame, states: DataFrame, keys: list[str], time: str, since: str, state: list[str],
    block: Callable[[Column], Column],
) -> DataFrame:
    """Each row with the state of its keys at its own time: the last one since then or before, else NULL.

    Of states that start at one time the greatest counts. `block` turns a time into its block, such as its month.
    """
    fields = [rows.schema[c] for c in rows.columns]
    none = F.lit(None)
    starts = states.select(
        *keys, F.col(since).alias("_time"), F.lit(0).alias("_side"), F.struct(*state).alias("_state"),
        F.struct(*[none.cast(f.dataType).alias(f.name) for f in fields]).alias("_row"),
    )
    kind = starts.schema["_state"].dataType
    asked = rows.select(
        *keys, F.col(time).alias("_time"), F.lit(1).alias("_side"), none.cast(kind).alias("_state"),
        F.struct(*rows.columns).alias("_row"),
    )
    both = starts.union(asked)
    order = ["_time", "_side", "_state"]
    found = carry_last(both, keys, block(F.col("_time")), order, "_state", "_found")
    return found.where("_side = 1").select("_row.*", *[F.col(f"_found.{c}").alias(c) for c in state])


def framed(
    df: DataFrame, keys: list[str], block: list[str], order: list[str], before: int, after: int,
    columns: Callable[[object], dict[str, Column]], page: int = PAGE,
) -> DataFrame:
    """Add window columns that look at most `before` rows back and `after` rows ahead in the order of the keys.

    Rows are numbered first, so pages have exactly `page` rows and one neighbour each way is enough: the rows next to
    a border are copied into the neighbouring page. `columns` gets the window of a page, ordered; no two rows agree on
    keys, block and order.
    """
    if page < max(before, after):
        raise ValueError("a page must be as long as the frame")
    one = df.withColumn("_one", F.lit(1))
    placed = count_before(one, keys, block, order, "_one", "_at").drop("_one", "_at_all")
    own, inside = int_div(F.col("_at"), F.lit(page)), F.col("_at") % page
    pages = F.array(
        own, F.when(inside < after, own - 1), F.when(inside >= page - before, own + 1)
    )
    dealt = placed.withColumn("_own", own).withColumn("_page", F.explode(F.array_compact(pages)))
    window = Window.partitionBy(*keys, "_page").orderBy("_at")
    told = dealt.withColumns(columns(window)).where("_page = _own")
    return told.drop("_at", "_own", "_page")


def sketch_blocks(df: DataFrame, keys: list[str], value: str, name: str = "_block") -> DataFrame:
    """Add the row's block: its place among the quantiles of its keys' values, taken from a sketch.

    Every block has about the same number of rows that differ in their value, however the values are spread.
    """
    shares = [i / BLOCKS for i in range(1, BLOCKS)]
    key = F.struct(*keys) if keys else F.lit(0)
    keyed = df.withColumn("_key", key)
    borders = keyed.groupBy("_key").agg(
        F.percentile_approx(value, shares, 10 * BLOCKS).alias("_fine")
    )
    coarse = F.transform(
        F.sequence(F.lit(COARSE), F.lit(BLOCKS - COARSE), F.lit(COARSE)), lambda i: F.get("_fine", i - 1)
    )
    borders = borders.withColumn("_coarse", coarse)
    below = lambda of: F.size(F.filter(of, lambda b: b < F.col(value)))
    part = below("_coarse") * COARSE
    block = part + below(F.slice("_fine", part + 1, F.lit(COARSE)))
    return keyed.join(borders, "_key").withColumn(name, block).drop("_key", "_fine", "_coarse")


def rank_even(df: DataFrame, keys: list[str], value: str, name: str = "rn") -> DataFrame:
    """Add `name`, the rank of the value in its keys, highest first, ties alike, and `rows`, the keys' row count.

    Equal values are merged first and ranked in blocks of a quantile sketch, so neither a value that most rows have
    nor values that crowd in a small range make a large block. NULL ranks last.
    """
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    blocked = sketch_blocks(read_alike(counted), keys, value)
    # count_before adds up ascending; what is not before or equal is above
    placed = count_before(blocked, keys, ["_block"], [value], "_n", "_below")
    above = F.col("_below_all") - F.col("_below") - F.col("_n")
    ranks = placed.select(
        F.struct(*keys, value).alias("_key"), (above + 1).alias(name), F.col("_below_all").alias("rows")
    )
    return df.withColumn("_key", F.struct(*keys, value)).join(ranks, "_key").drop("_key")


def step_times(
    events: DataFrame, keys: list[str], time: str, order: list[str], steps: list[Column], gap: str | None,
    block: Callable[[Column], Column],
) -> DataFrame:
    """Add `step_1`, `step_2`, ...: the event's time if it completes that step, else NULL.

    An event completes the first step by itself, and a later one if an earlier event completed the step before, the
    last time at most `gap` ago. The latest completion is the one that leaves most time, so it is all that the steps
    carry, from event to event and over the borders of blocks.
    """
    found = events.withColumn("step_1", F.when(steps[0], F.col(time)))
    for number, step in enumerate(steps[1:], 2):
        found = carry_last(found, keys, block(F.col(time)), order, f"step_{number - 1}", "_before")
        on_time = F.col("_before").isNotNull()
        if gap:
            on_time = on_time & (F.col(time) <= F.col("_before") + F.expr(f"INTERVAL {gap}"))
        found = found.withColumn(f"step_{number}", F.when(step & on_time, F.col(time))).drop("_before")
    return found


def ordered_funnel(
    events: DataFrame, keys: list[str], time: str, order: list[str], steps: dict[str, Column], gap: str | None,
    block: Callable[[Column], Column],
) -> DataFrame:
    """(number, step, reached): how many keys complete each step of a list, in this order."""
    timed = step_times(events, keys, time, order, list(steps.values()), gap, block)
    numbers = range(1, len(steps) + 1)
    per_key = timed.groupBy(*keys).agg(*[F.count(f"step_{i}").alias(f"step_{i}") for i in numbers])
    sums = per_key.agg(*[F.count_if(F.col(f"step_{i}") > 0).alias(f"step_{i}") for i in numbers])
    rows = [
        F.struct(F.lit(i).alias("number"), F.lit(name).alias("step"), F.col(f"step_{i}").alias("reached"))
        for i, name in enumerate(steps, 1)
    ]
    return sums.select(F.inline(F.array(*rows)))


def runs(df: DataFrame, keys: list[str], period: str, width: int = 4096) -> DataFrame:
    """(keys, first, last, n_periods, missing): the runs of neighbouring periods (whole numbers) that a key has rows
    in, and how many periods are missing before its next run (NULL after the last one)."""
    present = df.select(*keys, period).distinct()
    present = present.withColumn("_range", int_div(F.col(period), F.lit(width))).withColumn("_one", F.lit(1))
    placed = count_before(present, keys, ["_range"], [period], "_one", "_at")
    run = (F.col(period) - F.col("_at")).alias("_run")
    found = placed.groupBy(*keys, run).agg(
        F.min(period).alias("first"), F.max(period).alias("last"), F.count(F.lit(1)).alias("n_periods")
    )
    ranged = found.drop("_run").withColumn("_range", int_div(F.col("first"), F.lit(width)))

    def missing(window):
        return {"missing": F.lead("first").over(window) - F.col("last") - 1}

    return framed(ranged, keys, ["_range"], ["first"], 0, 1, missing).drop("_range")
