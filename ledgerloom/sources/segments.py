"""Interest segment inputs from order lines and suppliers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import MONEY, cents, ratio
from ..operators.positions import rank_values
from .tables import read_table

# An interest is a supplier and a return flag; months below the threshold are thin.
FLAGS = {"A": 0, "N": 1, "R": 2}
MIN_MONTHS = 75
AFTER = "1995-03-01"
# Value range of one block when the compositions of a month are ranked.
RANK_BLOCK = 16


def _interest(supplier: Column, flag: Column) -> Column:
    number = F.when(flag == "A", FLAGS["A"]).when(flag == "N", FLAGS["N"]).otherwise(FLAGS["R"])
    return supplier * len(FLAGS) + number


def interest_metrics(spark: SparkSession, folder: str, ranks: bool = True) -> DataFrame:
    """Monthly composition and index per interest; a few parts carry no month.

    The rank within a month is only worked out when asked for.
    """
    lines = read_table(spark, folder, "lineitem")
    # Group by numbers; the text columns are made from the groups.
    month = F.year("l_shipdate") * 12 + F.month("l_shipdate") - 1
    dated = F.when(F.col("l_partkey") % 50 != 0, month)
    interest = _interest(F.col("l_suppkey"), F.col("l_returnflag"))
    sums = lines.groupBy(interest.alias("interest"), dated.alias("month")).agg(
        F.sum(cents(F.col("l_quantity"))).alias("quantity"),
        F.sum(cents(F.col("l_discount"))).alias("discount"),
        F.count(F.lit(1)).alias("n"),
    )
    # A tenth of the quantity, from cents.
    tenth = F.col("quantity").cast("decimal(18,0)") * F.lit("0.001").cast("decimal(4,3)")
    two_digits = F.lpad((F.col("month") % 12 + 1).cast("string"), 2, "0")
    year = F.floor(F.col("month") / 12).cast("string")
    metrics = sums.select(
        F.concat(two_digits, F.lit("-"), year).alias("month_year"),
        F.col("interest").cast("string").alias("interest_id"),
        tenth.cast(MONEY).alias("composition"),
        (F.lit(1) + ratio(F.col("discount"), F.col("n") * 100, 4)).cast("decimal(18,4)")
        .alias("index_value"),
    )
    if not ranks:
        return metrics
    keyed = metrics.withColumn("_month", F.coalesce("month_year", F.lit("")))
    ranked = rank_values(keyed, ["_month"], "composition", RANK_BLOCK, "ranking")
    below = ratio(F.col("ranking"), F.col("rows"), 2, times=100)
    return ranked.select(
        *metrics.columns,
        "ranking",
        (F.lit(100) - below).cast(MONEY).alias("percentile_ranking"),
    )


def interest_map(spark: SparkSession, folder: str) -> DataFrame:
    """Interests of the suppliers that are not in debt, plus one unused id for the richest."""
    suppliers = read_table(spark, folder, "supplier")
    numbers = F.explode(F.array(*[F.lit(n) for n in FLAGS.values()]))
    used = suppliers.filter(F.col("s_acctbal") >= 0).withColumn("_flag", numbers).select(
        (F.col("s_suppkey") * len(FLAGS) + F.col("_flag")).alias("id"),
        F.concat("s_name", F.lit(" "), F.col("_flag").cast("string")).alias("interest_name"),
        "s_nationkey", "s_suppkey",
    )
    unused = suppliers.filter(F.col("s_acctbal") > 9000).select(
        (-F.col("s_suppkey") - 1).alias("id"),
        F.concat("s_name", F.lit(" unused")).alias("interest_name"),
        "s_nationkey", "s_suppkey",
    )
    created = F.date_add(F.lit("1998-01-15").cast("date"), (F.col("s_suppkey") % 300).cast("int"))
    return used.union(unused).select(
        "id",
        "interest_name",
        F.concat(F.lit("S"), F.col("s_nationkey").cast("string")).alias("interest_summary"),
        created.alias("created_at"),
        F.date_add(created, 30).alias("last_modified"),
    )
