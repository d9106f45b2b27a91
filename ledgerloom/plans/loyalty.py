"""Restaurant loyalty: spend, first and favourite items, points, member orders.

Inputs: sales(customer_id, order_date, product_id), menu(product_id, product_name,
price), members(customer_id, join_date), the last two with one row per id. Sales are
merged per customer and day or product before they meet members, so a customer with
very many sales is small there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import int_div
from ..operators.positions import number_rows
from ..operators.sharing import read_alike
from ..operators.topn import first_per_key, leaders, top_n

# Products of one block when a customer's orders of a day are numbered.
PRODUCT_BLOCK = 1_000_000
# The name as second sort column lets the sort split a customer with very many rows.
BY_CUSTOMER = ("customer_id", "product_name")


def _priced(sales: DataFrame, menu: DataFrame) -> DataFrame:
    return sales.join(menu, "product_id")


def _named(df: DataFrame, menu: DataFrame) -> DataFrame:
    return df.join(menu.select("product_id", "product_name"), "product_id")


def spend_per_customer(sales: DataFrame, menu: DataFrame) -> DataFrame:
    spend = F.sum("price").cast("decimal(18,2)")
    return _priced(sales, menu).groupBy("customer_id").agg(spend.alias("total_spend"))


def visit_days(sales: DataFrame) -> DataFrame:
    return sales.groupBy("customer_id").agg(F.count_distinct("order_date").alias("num_visited"))


def first_item(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """First product of each customer; same-day ties go to the lowest product id."""
    first = first_per_key(sales, ["customer_id"], ["order_date", "product_id"])
    return _named(first, menu).select("customer_id", "product_name")


def most_purchased_item(sales: DataFrame, menu: DataFrame) -> DataFrame:
    counts = sales.groupBy("product_id").agg(F.count("product_id").alias("prod_count"))
    named = _named(counts, menu)
    return top_n(named, "prod_count", 1, ["product_id"]).select("product_name", "prod_count")


def favourite_item(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Products each customer bought most often, ties kept."""
    known = sales.filter(F.col("product_id").isNotNull())
    counts = known.groupBy("customer_id", "product_id").agg(F.count(F.lit(1)).alias("n"))
    best = leaders(counts, ["customer_id"], "n")
    return _named(best, menu).select("customer_id", "product_name").orderBy(*BY_CUSTOMER)


def first_item_after_join(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    daily = first_per_key(sales, ["customer_id", "order_date"], ["product_id"])
    since = daily.join(members, "customer_id").filter(F.col("order_date") >= F.col("join_date"))
    first = first_per_key(since, ["customer_id"], ["order_date", "product_id"])
    return _named(first, menu).select("customer_id", "product_name")


def items_before_join(
    sales: DataFrame, menu: DataFrame, members: DataFrame, last_only: bool = False
) -> DataFrame:
    """Distinct items bought before joining; `last_only` keeps those of the last such day."""
    if last_only:
        bought = sales.select("customer_id", "order_date", "product_id").distinct()
        before = bought.join(members, "customer_id").filter(F.col("order_date") < F.col("join_date"))
        last = leaders(read_alike(before), ["customer_id"], "order_date")
        # Null-safe, so that no NULL test on the product reaches only one of both readers.
        names = menu.select(F.col("product_id").alias("_id"), "product_name")
        named = last.join(names, F.col("product_id").eqNullSafe(F.col("_id")))
        return named.select("customer_id", "product_name").distinct().orderBy(*BY_CUSTOMER)
    bought = (
        sales.groupBy("customer_id", "product_id")
        .agg(F.min("order_date").alias("order_date"))
        .join(members, "customer_id")
        .filter(F.col("order_date") < F.col("join_date"))
    )
    named = _named(bought, menu).select("customer_id", "product_name").distinct()
    return named.orderBy(*BY_CUSTOMER)


def totals_before_join(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    daily = (
        _priced(sales, menu)
        .groupBy("customer_id", "order_date")
        .agg(F.count("product_id").alias("products"), F.sum("price").alias("spent"))
    )
    before = daily.join(members, "customer_id").filter(F.col("order_date") < F.col("join_date"))
    return (
        before.groupBy("customer_id")
        .agg(
            F.sum("products").alias("total_products"),
            F.sum("spent").cast("decimal(18,2)").alias("total_spent"),
        )
        .orderBy("customer_id")
    )


def loyalty_points(sales: DataFrame, menu: DataFrame, bonus: Column | None = None) -> DataFrame:
    """10 points per unit of price, 20 for the bonus product (product 1 unless given)."""
    bonus = F.col("product_id") == 1 if bonus is None else bonus
    points = menu.select("product_id", (F.col("price") * F.when(bonus, 20).otherwise(10)).alias("x"))
    total = F.sum("x").cast("decimal(18,2)")
    return sales.join(points, "product_id").groupBy("customer_id").agg(total.alias("total_pts"))


def promo_window_points(
    sales: DataFrame, menu: DataFrame, members: DataFrame, end: Column
) -> DataFrame:
    """Double points in the first week, single points up to `end`; NULL if all lie outside."""
    daily = (
        _priced(sales, menu)
        .groupBy("customer_id", "order_date")
        .agg(F.sum("price").alias("price"))
    )
    day, joined = F.col("order_date"), F.col("join_date")
    week_end = F.date_add(joined, 6)
    points = F.when(day.between(joined, week_end), F.col("price") * 2).when(
        day.between(week_end, end), F.col("price")
    )
    return (
        daily.join(members, "customer_id")
        .groupBy(F.col("customer_id").alias("Customer"))
        .agg(F.sum(points).cast("decimal(18,2)").alias("Total_pts"))
    )


def _flagged(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    member = F.when(F.col("order_date") >= F.col("join_date"), "Y").otherwise("N")
    return _priced(sales, menu).join(members, "customer_id", "left").select(
        F.col("customer_id").alias("Customer"),
        "order_date", "product_id", "product_name", "price",
        member.alias("member"),
    )


def member_flagged_orders(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    return _flagged(sales, menu, members).drop("product_id")


def member_order_rank(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """Number of the order among the customer's member orders, NULL for the others.

    The question is put as row number minus the running count of non-member orders,
    NULL below 1. A customer joins once, so all non-member orders come before the
    member orders, and that difference is the row number within the flag.
    """
    block = {
        "_day": F.col("order_date"),
        "_product": int_div(F.col("product_id"), F.lit(PRODUCT_BLOCK)),
    }
    order = ["product_id", "product_name", "price"]
    numbered = number_rows(
        _flagged(sales, menu, members), ["Customer", "member"], block, order
    )
    return numbered.select(
        "Customer", "order_date", "product_name", "price", "member",
        F.when(F.col("member") == "Y", F.col("row_no")).alias("ranking"),
    )
