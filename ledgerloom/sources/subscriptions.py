"""Subscription inputs from orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# Plan id, name, price.
PLANS = [
    (0, "trial", "0.00"),
    (1, "basic monthly", "9.90"),
    (2, "pro monthly", "19.90"),
    (3, "pro annual", "199.00"),
    (4, "churn", None),
]
YEAR = 1995


def subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    """First order of each customer per priority as the start of the plan of that number.

    One aggregate per customer and a per-row expansion: the result stays
    partitioned by customer, so the windows of the jobs need no further shuffle.
    """
    orders = read_table(spark, folder, "orders")
    plan = F.substring("o_orderpriority", 1, 1).cast("int") - 1
    day = F.col("o_orderdate").cast("date")
    starts = orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        *[F.min(F.when(plan == p, day)).alias(f"start_{p}") for p, _, _ in PLANS]
    )
    states = F.array(
        *[
            F.struct(F.lit(p).alias("plan_id"), F.col(f"start_{p}").alias("start_date"))
            for p, _, _ in PLANS
        ]
    )
    held = F.filter(states, lambda s: s["start_date"].isNotNull())
    return starts.select("customer_id", F.inline(held))


def plans(spark: SparkSession) -> DataFrame:
    rows = ", ".join(
        f"({p}, '{name}', CAST({price or 'NULL'} AS DECIMAL(18,2)))" for p, name, price in PLANS
    )
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(plan_id, plan_name, price)")
