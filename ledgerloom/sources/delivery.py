"""Delivery inputs from orders, order lines, parts and customers.

Text columns are made dirty on purpose: null words, lists and units.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# Topping ids and names.
TOPPINGS = [
    (1, "Bacon"),
    (2, "BBQ Sauce"),
    (3, "Beef"),
    (4, "Cheese"),
    (5, "Chicken"),
    (6, "Mushrooms"),
    (7, "Onions"),
    (8, "Pepperoni"),
    (9, "Peppers"),
    (10, "Salami"),
    (11, "Tomatoes"),
    (12, "Tomato Sauce"),
]
# The two base recipes.
MEAT_RECIPE = "1, 2, 3, 4, 5, 6, 8, 10"
VEGETARIAN_RECIPE = "4, 6, 7, 9, 11, 12"


def _text(number: Column) -> Column:
    return number.cast("string")


def _order_time() -> Column:
    minutes = (F.col("o_orderkey") % 1440).cast("int")
    return F.col("o_orderdate") + F.make_dt_interval(mins=minutes)


def customer_orders(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"
    )
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    one = _text(F.col("l_suppkey") % 12 + 1)
    two = F.concat(one, F.lit(", "), _text(F.col("l_linenumber") % 12 + 1))
    kind, extra = F.col("l_partkey") % 4, F.col("l_partkey") % 5
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        (F.col("l_partkey") + 1).alias("pizza_id"),
        F.when(kind == 0, "").when(kind == 1, "null").when(kind == 2, one).otherwise(two)
        .alias("exclusions"),
        F.when(extra == 1, "").when(extra == 2, "NaN").when(extra == 3, one)
        .when(extra == 4, two).alias("extras"),
        _order_time().alias("order_time"),
    )


def runner_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    key = F.col("o_orderkey")
    cancelled = key % 10 == 0
    pickup = _order_time() + F.make_dt_interval(
        mins=(5 + key % 50).cast("int"), secs=(key % 60).cast("decimal(18,6)")
    )
    distance = F.concat(
        _text(5 + key % 20), F.lit("."), _text(key % 10),
        F.when(key % 3 == 0, "km").when(key % 3 == 1, " km").otherwise(""),
    )
    duration = F.concat(
        _text(10 + key % 40),
        F.when(key % 4 == 0, " minutes").when(key % 4 == 1, "mins")
        .when(key % 4 == 2, " minute").otherwise(""),
    )
    reason = F.when(key % 20 == 0, "Restaurant Cancellation").otherwise("Customer Cancellation")
    return orders.select(
        key.alias("order_id"),
        (F.col("o_custkey") + 1).alias("runner_id"),
        F.when(cancelled, "null").otherwise(_text(pickup))
        .alias("pickup_time"),
        F.when(cancelled, "null").otherwise(distance).alias("distance"),
        F.when(cancelled, "null").otherwise(duration).alias("duration"),
        F.when(cancelled, reason).when(key % 3 == 0, "").when(key % 3 == 1, "null")
        .alias("cancellation"),
    )


def runners(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer as a runner, signed up on a day of 2021."""
    day = (F.col("c_custkey") % 365).cast("int")
    return read_table(spark, folder, "customer").select(
        (F.col("c_custkey") + 1).alias("runner_id"),
        F.date_add(F.lit("2021-01-01").cast("date"), day).alias("registration_date"),
    )


def pizza_names(spark: SparkSession, folder: str) -> DataFrame:
    """Every part as a pizza."""
    return read_table(spark, folder, "part").select(
        (F.col("p_partkey") + 1).alias("pizza_id"), F.col("p_name").alias("pizza_name")
    )


def pizza_recipes(spark: SparkSession, folder: str) -> DataFrame:
    """Every part as one of the two base recipes."""
    return read_table(spark, folder, "part").select(
        (F.col("p_partkey") + 1).alias("pizza_id"),
        F.when(F.col("p_partkey") % 2 == 0, MEAT_RECIPE).otherwise(VEGETARIAN_RECIPE)
        .alias("toppings"),
    )


def pizza_toppings(spark: SparkSession) -> DataFrame:
    """The twelve toppings; a literal table, so Spark knows its size."""
    rows = ", ".join(f"({number}, '{name}')" for number, name in TOPPINGS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(topping_id, topping_name)")
