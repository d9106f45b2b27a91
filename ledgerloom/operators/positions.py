"""Row numbers and ranks that never sort one hot key in one task.

A plain ranking window sends every row of a key to one task. Here equal rows are
first merged into counted rows (map side), the counted rows are numbered inside
small blocks of the key, and the blocks are numbered by their sizes. A block is a
coarse prefix of the sort order, so the result equals the plain window. Choose blocks
so that neither the rows of a block nor the blocks of a key are too many for a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import int_div
from ..session import small_partitions
from .sharing import read_alike

# Copies of one row that a task writes out at most.
COPIES_PER_TASK = 100_000


def count_before(
    df: DataFrame, keys: list[str], block: list[str], order: list[str], weight: str, name: str
) -> DataFrame:
    """Add `name`, the weight of the rows of the same keys that sort before, and `name`_all.

    The order is ascending by the block columns, then by `order`; no two rows agree on
    all of them. `name`_all is the weight of all rows of the keys.
    """

    def before(parent: list[str], by: list[str], amount: str) -> Column:
        earlier = Window.partitionBy(*parent).orderBy(*by).rowsBetween(
            Window.unboundedPreceding, -1
        )
        return F.coalesce(F.sum(amount).over(earlier), F.lit(0))

    # One struct as block key: NULL keys match each other, and the join adds no filter
    # that would keep Spark from reading the shuffled rows once for both sides.
    keyed = df.withColumn("_leaf", F.struct(*keys, *block))
    placed = keyed.withColumn(name, before(["_leaf"], order, weight))
    sizes = keyed.groupBy("_leaf").agg(F.sum(weight).alias("_size"))
    parent = [f"_leaf.{k}" for k in keys]
    offsets = sizes.select(
        "_leaf",
        before(parent, [f"_leaf.{b}" for b in block], "_size").alias("_skip"),
        F.sum("_size").over(Window.partitionBy(*parent)).alias(f"{name}_all"),
    )
    return (
        placed.join(offsets, "_leaf")
        .withColumn(name, F.col(name) + F.col("_skip"))
        .drop("_leaf", "_skip")
    )


def number_rows(
    df: DataFrame,
    keys: list[str],
    block: dict[str, Column],
    order: list[str],
    name: str = "row_no",
) -> DataFrame:
    """Add `name`: 1..n per key (row_number) by the block columns, then by `order`.

    Rows that tie on both must be equal in all columns. Each counted row gets the position
    where its copies start; only then are very many copies cut into pieces, which are dealt
    out so that several tasks write them.
    """
    small_partitions(df.sparkSession)
    columns = df.columns
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies")).withColumns(block)
    placed = count_before(counted, keys, list(block), order, "_copies", "_start")
    pieces = F.sequence(F.lit(0), int_div(F.col("_copies") - 1, F.lit(COPIES_PER_TASK)))
    first = F.col("_start") + F.col("_piece") * COPIES_PER_TASK
    last = F.least(first + COPIES_PER_TASK, F.col("_start") + F.col("_copies"))
    cut = placed.withColumn("_piece", F.explode(pieces)).select(
        *columns, "_piece", (first + 1).alias("_first"), last.alias("_last")
    )
    dealt = cut.repartition("_piece", "_first", *keys)
    return dealt.select(*columns, F.explode(F.sequence("_first", "_last")).alias(name))


def rank_values(
    df: DataFrame, keys: list[str], value: str, width: int, name: str = "rn"
) -> DataFrame:
    """Add `name`, the rank of the value in its keys, highest first, ties alike, and `rows`.

    `width` is the value range of one block; `rows` counts all rows of the keys. Rows are
    ranked inside their block and the blocks are offset by their sizes.
    """
    leaf = F.struct(*keys, F.floor(-F.col(value) / width).alias("_block")).alias("_leaf")
    # The sizes are counted from the very rows that are ranked.
    keyed = read_alike(df).select("*", leaf)
    inside = F.rank().over(Window.partitionBy("_leaf").orderBy(F.desc(value)))
    sizes = keyed.groupBy("_leaf").agg(F.count(F.lit(1)).alias("_size"))
    parent = Window.partitionBy(*[f"_leaf.{k}" for k in keys])
    earlier = parent.orderBy("_leaf._block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_leaf",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_skip"),
        F.sum("_size").over(parent).alias("rows"),
    )
    ranked = keyed.withColumn("_inside", inside).join(offsets, "_leaf")
    rank = (F.col("_inside") + F.col("_skip")).cast("int").alias(name)
    return ranked.select(*df.columns, rank, "rows")
