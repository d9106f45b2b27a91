"""Jobs that write: the caller names the folder, a second run leaves the same table."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .plans import delivery, weekly
from .sources import delivery as d_in
from .sources import weekly as w_in
from .sources.sinks import save_table
from .sources.tables import declared

RATINGS = (
    "order_id BIGINT, runner_id BIGINT, delivery_time_pts INT, pizza_condition INT, rating INT"
)


def store_clean_sales(spark: SparkSession, folder: str, path: str) -> str:
    """The cleaned weekly sales as a table partitioned by year; replaces what was there."""
    sales = declared(w_in.weekly_sales(spark, folder), "weekly_sales")
    return save_table(weekly.clean_weekly_sales(sales), path, ["calendar_year"])


def store_ratings(spark: SparkSession, folder: str, path: str, per: str = "line") -> str:
    """The declared rating table, made anew with the ratings in it; a run that is repeated doubles nothing."""
    table = spark.createDataFrame([], RATINGS)
    orders = declared(d_in.customer_orders(spark, folder), "customer_orders")
    runs = declared(d_in.runner_orders(spark, folder), "runner_orders")
    ratings = delivery.runner_ratings(orders, runs, per)
    return save_table(table.union(ratings), path)
