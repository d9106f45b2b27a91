"""Weekly retail sales from order lines, orders and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import cents, int_div
from .tables import read_table

PIVOT = "1998-06-15"
YEARS = (1996, 1997)
# Return flag to customer type.
CUSTOMER_TYPES = {"A": "New", "N": "Existing", "R": "Guest"}


def weekly_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions and sales per week, region, platform, segment and customer type.

    Order lines are summed per order before they meet anything else, so each order
    is one transaction and no distinct count is needed.
    """
    price = cents(F.col("l_extendedprice"))
    flags = [
        F.sum(F.when(F.col("l_returnflag") == flag, price)).alias(name)
        for flag, name in CUSTOMER_TYPES.items()
    ]
    per_order = read_table(spark, folder, "lineitem").groupBy("l_orderkey").agg(*flags)
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"
    )
    nation = read_table(spark, folder, "nation")
    region = read_table(spark, folder, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.col("r_name").alias("region")
    )
    customer = read_table(spark, folder, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment"
    )
    buyers = customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("customer_type"), F.col(name).alias("amount"))
            for name in CUSTOMER_TYPES.values()
        ]
    )
    sold = F.filter(cells, lambda c: c["amount"].isNotNull())
    monday = F.date_trunc("week", "o_orderdate").cast("date")
    segment = F.col("c_mktsegment")
    facts = (
        per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            monday.alias("monday"),
            "region",
            F.when(F.col("o_orderstatus") == "F", "Retail").otherwise("Shopify").alias("platform"),
            F.when(segment == "AUTOMOBILE", "C1").when(segment == "BUILDING", "F1")
            .when(segment == "FURNITURE", "C2").when(segment == "HOUSEHOLD", "F3")
            .otherwise("null").alias("segment"),
            F.inline(sold),
        )
    )
    return (
        facts.groupBy("monday", "region", "platform", "segment", "customer_type")
        .agg(
            F.count(F.lit(1)).alias("transactions"),
            int_div(F.sum("amount"), F.lit(100)).alias("sales"),
        )
        .select(
            F.date_format("monday", "d/M/yy").alias("week_date"),
            "region", "platform", "segment", "customer_type", "transactions", "sales",
        )
    )
