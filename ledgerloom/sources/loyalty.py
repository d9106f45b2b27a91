"""Restaurant loyalty inputs from orders, order lines, parts and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import MONEY
from .tables import read_table

# Products that earn the bonus, and the days after joining that still earn points.
BONUS_EVERY = 10
PROMO_DAYS = 365


def sales(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("l_partkey").alias("product_id"),
    )


def menu(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_retailprice").cast(MONEY).alias("price"),
    )


def members(spark: SparkSession, folder: str) -> DataFrame:
    """Customers outside one market segment, joined 180 days after their first order."""
    joiners = (
        read_table(spark, folder, "customer")
        .filter(F.col("c_mktsegment") != "MACHINERY")
        .select("c_custkey")
    )
    first = (
        read_table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(F.min(F.col("o_orderdate").cast("date")).alias("first_date"))
    )
    return first.join(joiners, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_custkey").alias("customer_id"),
        F.date_add("first_date", 180).alias("join_date"),
    )
