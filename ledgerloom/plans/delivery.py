"""Pizza delivery: order metrics, runners, ingredients, prices and ratings.

Inputs: customer_orders, runner_orders, runners, pizza_names, pizza_recipes,
pizza_toppings as declared in sources.tables. Order lines are merged per order or
per content before joins wherever the answer allows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import minute_part, us_week
from ..functions.numbers import int_div, percent, ratio
from ..functions.text import (
    clean_token,
    element_numbers,
    elements,
    list_size,
    present,
    unit_number,
)
from ..operators.lists import render_list, tokenize_list
from ..operators.positions import number_rows
from ..operators.sharing import read_alike
from ..operators.topn import not_in, top_n
from ..sources.sinks import append_rows

CONTENT = ["pizza_id", "exclusions", "extras"]
# Pizzas of one block when the lines of an order are numbered.
PIZZA_BLOCK = 100_000
# Prices and the pay per kilometre.
PREMIUM_PRICE, PRICE = 12, 10
PER_KM = "0.30"


def _km() -> Column:
    return unit_number(F.col("distance"), "decimal(10,2)")


def _minutes() -> Column:
    return unit_number(F.col("duration"), "int")


def _prep_minutes() -> Column:
    pickup = clean_token(F.col("pickup_time")).try_cast("timestamp_ntz")
    return minute_part(F.col("order_time"), pickup)


def _price(premium: Column | None) -> Column:
    premium = F.col("pizza_id") == 1 if premium is None else premium
    return F.when(premium, PREMIUM_PRICE).otherwise(PRICE)


def _speed() -> Column:
    """Kilometres per minute rounded to cents before the step to hours."""
    minutes = unit_number(F.col("duration"), "decimal(10,2)")
    return (ratio(_km(), minutes, 2) * 60).cast("decimal(18,2)")


def _delivered(customer_orders: DataFrame, runner_orders: DataFrame) -> DataFrame:
    """Order lines whose order is not in the list of cancelled orders."""
    cancelled = runner_orders.filter(F.col("duration") == "null")
    return not_in(customer_orders, "order_id", cancelled, "order_id")


def _runs(runner_orders: DataFrame, column: str) -> DataFrame:
    """Runs whose column is not the null word (NULL drops out as well)."""
    return runner_orders.filter(F.col(column) != "null")


# Order metrics


def items_ordered(customer_orders: DataFrame) -> DataFrame:
    return customer_orders.agg(F.count(F.lit(1)).alias("Orders"))


def unique_customers(customer_orders: DataFrame) -> DataFrame:
    return customer_orders.agg(F.count_distinct("customer_id").alias("Unique_customer"))


def successful_orders(runner_orders: DataFrame, per_runner: bool = False) -> DataFrame:
    runs = _runs(runner_orders, "duration")
    runs = runs.groupBy("runner_id") if per_runner else runs.groupBy()
    return runs.agg(F.count("order_id").alias("Successful_Orders"))


def delivered_by_type(customer_orders: DataFrame, runner_orders: DataFrame) -> DataFrame:
    lines = _delivered(customer_orders, runner_orders)
    return lines.groupBy("pizza_id").agg(F.count(F.lit(1)).alias("number_of_orders"))


def type_by_customer(customer_orders: DataFrame) -> DataFrame:
    return customer_orders.groupBy("customer_id", "pizza_id").agg(
        F.count(F.lit(1)).alias("number_of_orders")
    )


def max_items_per_order(customer_orders: DataFrame) -> DataFrame:
    counts = customer_orders.groupBy("order_id", "customer_id").agg(
        F.count(F.lit(1)).alias("Max_orders")
    )
    return top_n(counts, "Max_orders", 1, ["order_id"]).select("order_id", "Max_orders")


def changes_per_customer(customer_orders: DataFrame, runner_orders: DataFrame) -> DataFrame:
    changes = list_size(F.col("exclusions")) + list_size(F.col("extras"))
    lines = _delivered(customer_orders, runner_orders).withColumn("changes", changes)
    return (
        lines.filter(F.col("changes") > 0)
        .groupBy("customer_id")
        .agg(F.sum("changes").alias("no_of_changes"))
    )


def both_changes_count(customer_orders: DataFrame, runner_orders: DataFrame) -> DataFrame:
    lines = _delivered(customer_orders, runner_orders)
    both = lines.filter(present(F.col("exclusions")) & present(F.col("extras")))
    return both.agg(F.count(F.lit(1)).alias("pizza_count"))


def volume_hour_day(customer_orders: DataFrame) -> DataFrame:
    return customer_orders.groupBy(
        "pizza_id",
        F.hour("order_time").alias("Hour"),
        F.dayofmonth("order_time").alias("Day"),
    ).agg(F.count(F.lit(1)).alias("ordered_pizza"))


def volume_day_week(customer_orders: DataFrame) -> DataFrame:
    return customer_orders.groupBy(
        F.dayofmonth("order_time").alias("Day"),
        us_week(F.col("order_time").cast("date")).alias("Week"),
    ).agg(F.count(F.lit(1)).alias("ordered_pizza"))


# Runners


def signups_by_week(runners: DataFrame) -> DataFrame:
    week = us_week(F.col("registration_date")).alias("week")
    return runners.groupBy(week).agg(F.count(F.lit(1)).alias("no_of_sign_ups"))


def _lines_per_order(customer_orders: DataFrame) -> DataFrame:
    return customer_orders.groupBy("order_id", "customer_id", "order_time").agg(
        F.count(F.lit(1)).alias("lines")
    )


def avg_pickup_minutes(
    customer_orders: DataFrame, runner_orders: DataFrame, per: str = "line"
) -> DataFrame:
    """Truncated average of the prep minutes; an order counts once per line or once."""
    runs = _runs(runner_orders, "pickup_time")
    weight = F.col("lines") if per == "line" else F.lit(1)
    timed = _lines_per_order(customer_orders).join(runs, "order_id").select(
        "runner_id", _prep_minutes().cast("bigint").alias("m"), weight.alias("w")
    )
    counted = F.sum(F.when(F.col("m").isNotNull(), F.col("w")))
    average = int_div(F.sum(F.col("m") * F.col("w")), counted)
    return timed.groupBy("runner_id").agg(average.alias("avg_pickup_time"))


def prep_time_vs_items(customer_orders: DataFrame, runner_orders: DataFrame) -> DataFrame:
    runs = _runs(runner_orders, "pickup_time")
    timed = _lines_per_order(customer_orders).join(runs, "order_id")
    return (
        timed.groupBy(F.col("order_id").alias("o_id"), _prep_minutes().alias("prep_time"))
        .agg(F.sum("lines").alias("no_pizza"))
        .orderBy("no_pizza", "o_id")
    )


def avg_distance(
    customer_orders: DataFrame, runner_orders: DataFrame, per: str = "line"
) -> DataFrame:
    runs = _runs(runner_orders, "distance")
    weight = F.col("lines") if per == "line" else F.lit(1)
    driven = _lines_per_order(customer_orders).join(runs, "order_id").select(
        "customer_id", _km().alias("km"), weight.alias("w")
    )
    average = ratio(F.sum(F.col("km") * F.col("w")), F.sum("w"), 2)
    return driven.groupBy("customer_id").agg(average.alias("avg_dist"))


def duration_spread(runner_orders: DataFrame) -> DataFrame:
    """Distance of each delivery time from the longest and the shortest."""
    runs = _runs(runner_orders, "duration").select("order_id", _minutes().alias("d"))
    ends = runs.agg(F.struct(F.max("d").alias("l"), F.min("d").alias("s")).alias("e")).scalar()
    return runs.select(
        "order_id",
        (ends["l"] - F.col("d")).alias("long_diff"),
        (F.col("d") - ends["s"]).alias("short_diff"),
    )


def avg_speed(runner_orders: DataFrame) -> DataFrame:
    runs = _runs(runner_orders, "duration")
    return runs.select("order_id", "runner_id", _speed().alias("avg_speed"))


def delivery_pct(runner_orders: DataFrame, as_written: bool = False) -> DataFrame:
    """Share of delivered orders; `as_written` takes one order off every runner."""
    counts = runner_orders.groupBy("runner_id").agg(
        F.count("runner_id").alias("total_orders"),
        F.count_if(F.col("duration") != "null").alias("delivered"),
        F.count("duration").alias("known"),
    )
    if as_written:
        counts = counts.filter(F.col("known") > 0)
        done = F.col("total_orders") - 1
    else:
        done = F.col("delivered")
    return counts.select(
        "runner_id",
        done.alias("s_orders"),
        "total_orders",
        percent(done, F.col("total_orders")).alias("s_percentage"),
    )


# Ingredients


def _cleaned(customer_orders: DataFrame) -> DataFrame:
    return customer_orders.withColumns(
        {"exclusions": clean_token(F.col("exclusions")), "extras": clean_token(F.col("extras"))}
    )


def _records(lines: DataFrame) -> DataFrame:
    """Cleaned lines with a record id made of the order and the line's number in it.

    Lines of an order are numbered by content first, so records that need no other
    columns can be numbered without them and still match.
    """
    block = {"_block": int_div(F.col("pizza_id"), F.lit(PIZZA_BLOCK))}
    order = [*CONTENT, *[c for c in lines.columns if c not in ("order_id", *CONTENT)]]
    numbered = number_rows(_cleaned(lines), ["order_id"], block, order, "seq")
    record = F.concat_ws("-", F.col("order_id").cast("string"), F.col("seq").cast("string"))
    return numbered.select(record.alias("record_id"), *lines.columns)


def _content_records(customer_orders: DataFrame) -> DataFrame:
    return _records(customer_orders.select("order_id", *CONTENT))


def clean_orders(customer_orders: DataFrame) -> DataFrame:
    """Null words to NULL, and a record id."""
    return _records(customer_orders)


def explode_extras(customer_orders: DataFrame) -> DataFrame:
    records = _content_records(customer_orders)
    return tokenize_list(records, "extras", "topping_id").select(
        "record_id", "order_id", "topping_id"
    )


def explode_exclusions(customer_orders: DataFrame) -> DataFrame:
    records = _content_records(customer_orders)
    return tokenize_list(records, "exclusions", "topping_id").select("record_id", "topping_id")


def _recipe_rows(pizza_recipes: DataFrame, pizza_toppings: DataFrame) -> DataFrame:
    parts = tokenize_list(pizza_recipes, "toppings", "part")
    parts = parts.select("pizza_id", F.col("part").try_cast("int").alias("topping_id"))
    return parts.join(pizza_toppings, "topping_id")


def standard_ingredients(pizza_recipes: DataFrame, pizza_toppings: DataFrame) -> DataFrame:
    return _recipe_rows(pizza_recipes, pizza_toppings).select(
        "pizza_id", F.col("topping_id").alias("t_id"), "topping_name"
    )


def _top_element(customer_orders: DataFrame, column: str) -> DataFrame:
    lists = customer_orders.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    parts = tokenize_list(lists, column, "part")
    counts = parts.groupBy(F.col("part").try_cast("int").alias("topping_id")).agg(
        F.sum("n").alias("frequency")
    )
    return top_n(counts.filter(F.col("topping_id") != 0), "frequency", 1, ["topping_id"])


def top_extra(customer_orders: DataFrame) -> DataFrame:
    return _top_element(customer_orders, "extras")


def top_exclusion(customer_orders: DataFrame) -> DataFrame:
    return _top_element(customer_orders, "exclusions")


def _list_names(lists: DataFrame, pizza_toppings: DataFrame) -> DataFrame:
    """Each distinct list text with its topping names: rendered once, not per record."""
    texts = lists.select(F.explode(F.array("extras", "exclusions")).alias("text")).distinct()
    parts = texts.select("text", F.posexplode(elements(F.col("text"))).alias("pos", "part"))
    named = parts.withColumn("topping_id", F.col("part").try_cast("int")).join(
        pizza_toppings, "topping_id"
    )
    return render_list(named, ["text"], ["topping_id", "pos"], "topping_name", "names")


def order_description(
    customer_orders: DataFrame, pizza_names: DataFrame, pizza_toppings: DataFrame
) -> DataFrame:
    """'Name - Extra a, b - Exclude c' per record."""
    lists = _cleaned(customer_orders.select("extras", "exclusions").distinct()).distinct()
    names = _list_names(lists, pizza_toppings)

    def option(column: str, prefix: str, name: str) -> DataFrame:
        return names.select(
            F.col("text").alias(column), F.concat(F.lit(prefix), "names").alias(name)
        )

    options = lists.join(option("extras", "Extra ", "_extra"), "extras", "left").join(
        option("exclusions", "Exclude ", "_exclude"), "exclusions", "left"
    )
    # Equality joins drop NULL lists, so the pair is looked up with '' for them.
    pair = {c: F.coalesce(c, F.lit("")) for c in ("extras", "exclusions")}
    details = F.concat_ws(" - ", "pizza_name", "_extra", "_exclude").alias("order_details")
    return (
        _content_records(customer_orders)
        .join(pizza_names, "pizza_id")
        .withColumns(pair)
        .join(options.withColumns(pair), list(pair))
        .select("record_id", details)
    )


def cleaned_toppings(pizza_recipes: DataFrame, pizza_toppings: DataFrame) -> DataFrame:
    """Recipe table with one row per topping; the id stays text as in the list."""
    return _recipe_rows(pizza_recipes, pizza_toppings).select(
        "pizza_id", F.col("topping_id").cast("string").alias("topping_id"), "topping_name"
    )


def _portions(
    lines: DataFrame, pizza_recipes: DataFrame, pizza_toppings: DataFrame
) -> DataFrame:
    """Recipe toppings of each distinct line content with how often they are used.

    2 if the topping is also an extra, 0 if excluded, else 1. `n` is the number of
    lines with that content, so hot pizzas meet the recipe once per content.
    """
    return _contents_portions(
        _cleaned(lines).groupBy(*CONTENT).agg(F.count(F.lit(1)).alias("n")),
        pizza_recipes,
        pizza_toppings,
    )


def _contents_portions(
    contents: DataFrame, pizza_recipes: DataFrame, pizza_toppings: DataFrame
) -> DataFrame:
    # Lists are split once per content, before the recipe multiplies the rows.
    lists = {f"_{c}": element_numbers(F.col(c)) for c in ("extras", "exclusions")}
    # Looked up by a struct, which adds no NULL filter that would change the scan below.
    recipes = pizza_recipes.select(F.struct("pizza_id").alias("_pizza"), "toppings")
    rows = contents.withColumns(lists).withColumn("_pizza", F.struct("pizza_id"))
    rows = rows.join(recipes, "_pizza")
    rows = tokenize_list(rows, "toppings", "part")
    rows = rows.withColumn("topping_id", F.col("part").try_cast("int"))
    # NULL for a missing list, which counts as not listed.
    extra, excluded = (F.array_contains(c, F.col("topping_id")) for c in lists)
    times = F.when(extra, 2).when(excluded, 0).otherwise(1)
    return rows.withColumn("times", times).join(pizza_toppings, "topping_id")


def ingredient_usage(
    customer_orders: DataFrame, pizza_recipes: DataFrame, pizza_toppings: DataFrame
) -> DataFrame:
    portions = _portions(customer_orders, pizza_recipes, pizza_toppings)
    return (
        portions.groupBy("topping_name")
        .agg(F.sum(F.col("times") * F.col("n")).alias("times_used"))
        .orderBy(F.desc("times_used"), "topping_name")
    )


def ingredient_list(
    customer_orders: DataFrame, pizza_recipes: DataFrame, pizza_toppings: DataFrame
) -> DataFrame:
    """Alphabetical ingredients per record, '2x' in front of those that are also extras."""
    # The same counted lines as the records are numbered from, so both read one shuffle.
    lines = _cleaned(customer_orders.select("order_id", *CONTENT))
    counted = lines.groupBy("order_id", *CONTENT).agg(F.count(F.lit(1)).alias("copies"))
    contents = counted.groupBy(*CONTENT).agg(F.sum("copies").alias("n")).filter(F.col("n") > 0)
    portions = _contents_portions(contents, pizza_recipes, pizza_toppings)
    # Equality joins drop NULL lists, so the content key holds '' for them.
    keys = {c: F.coalesce(c, F.lit("")) for c in ("exclusions", "extras")}
    label = F.concat(F.when(F.col("times") == 2, "2x").otherwise(""), F.col("topping_name"))
    used = portions.filter(F.col("times") > 0).withColumns({**keys, "label": label})
    texts = render_list(used, CONTENT, ["topping_name"], "label", "ingredients")
    # Looked up by a struct, so that no NULL test reaches only one of both readers of the lines.
    content = F.struct(*CONTENT).alias("_content")
    records = _content_records(customer_orders).withColumns(keys).select("record_id", content)
    return records.join(texts.select(content, "ingredients"), "_content", "left").select(
        "record_id", "ingredients"
    )


def ingredient_usage_delivered(
    customer_orders: DataFrame,
    runner_orders: DataFrame,
    pizza_recipes: DataFrame,
    pizza_toppings: DataFrame,
    delivered_only: bool = False,
) -> DataFrame:
    lines = _delivered(customer_orders, runner_orders) if delivered_only else customer_orders
    usage = ingredient_usage(lines, pizza_recipes, pizza_toppings)
    return usage.withColumnRenamed("topping_name", "tn")


# Prices and ratings


def revenue_per_runner(
    customer_orders: DataFrame, runner_orders: DataFrame, premium: Column | None = None
) -> DataFrame:
    cost = customer_orders.groupBy("order_id").agg(F.sum(_price(premium)).alias("cost"))
    return (
        cost.join(_runs(runner_orders, "duration"), "order_id")
        .groupBy("runner_id")
        .agg(F.sum("cost").alias("cost"))
    )


def revenue_with_extras(
    customer_orders: DataFrame, runner_orders: DataFrame, premium: Column | None = None
) -> DataFrame:
    each = _price(premium) + list_size(F.col("extras"))
    cost = customer_orders.groupBy("order_id").agg(F.sum(each).alias("cost"))
    return (
        cost.join(_runs(runner_orders, "duration"), "order_id")
        .groupBy("runner_id")
        .agg(F.sum("cost").alias("cost"))
    )


def order_total_time(customer_orders: DataFrame, runner_orders: DataFrame) -> DataFrame:
    orders = customer_orders.select("order_id", "order_time").distinct()
    runs = _runs(runner_orders, "pickup_time")
    total = (_prep_minutes() + _minutes()).alias("total_time")
    return orders.join(runs, "order_id").select("order_id", total).distinct()


def _rated(runner_orders: DataFrame, *columns: str) -> DataFrame:
    """Points by delivery time, and a repeatable 1-5 for the state of the pizza."""
    m = _minutes()
    points = (
        F.when(m <= 15, 5).when(m.between(16, 25), 4).when(m.between(26, 35), 3)
        .when(m.between(36, 45), 2).otherwise(1)
    )
    # A fixed linear congruential step on the order id stands in for a random draw.
    draw = (F.col("order_id") % 2147483648) * 1103515245 + 12345
    condition = F.greatest(int_div(draw, F.lit(65536)) % 6, F.lit(1)).cast("int")
    return _runs(runner_orders, "pickup_time").select(
        "order_id", "runner_id",
        points.alias("delivery_time_pts"),
        condition.alias("pizza_condition"),
        int_div(points + condition, F.lit(2)).cast("int").alias("rating"),
        *columns,
    )


def runner_ratings(
    customer_orders: DataFrame, runner_orders: DataFrame, per: str = "line"
) -> DataFrame:
    """Ratings of delivered orders, once per order line as written or once per order."""
    lines = customer_orders.select("order_id")
    if per == "order":
        return _rated(runner_orders).join(lines, "order_id", "left_semi")
    return lines.join(_rated(runner_orders), "order_id")


def customer_order_counts(customer_orders: DataFrame) -> DataFrame:
    return customer_orders.groupBy("customer_id").agg(
        F.count("customer_id").alias("total_orders")
    )


def delivery_fact(customer_orders: DataFrame, runner_orders: DataFrame) -> DataFrame:
    """One row per delivered order with rating, times, speed and the customer's order count.

    Lines are merged per order before the runs are joined, so they never pair up; the same
    merged rows give the customer's total. An order has one run.
    """
    orders = read_alike(_lines_per_order(customer_orders))
    totals = orders.groupBy(F.col("customer_id").alias("_customer")).agg(
        F.sum("lines").alias("total_orders")
    )
    # A run is rated from its own row; only runs with a pickup time have a rating.
    rated = _runs(_rated(runner_orders, "pickup_time", "distance", "duration"), "duration")
    rated = rated.filter(F.col("order_id").isNotNull()).withColumnRenamed("order_id", "_order")
    # Null-safe joins, so that no NULL test reaches only one of both readers of the orders.
    facts = (
        orders.join(rated, F.col("order_id").eqNullSafe(F.col("_order")))
        .select(
            "customer_id", "order_id", "runner_id", "rating", "order_time", "pickup_time",
            _prep_minutes().alias("time_between_order_and_pickup"),
            _minutes().alias("delivery_duration"),
            _speed().alias("avg_speed"),
        )
        .distinct()
    )
    known = F.col("customer_id").eqNullSafe(F.col("_customer"))
    return facts.join(totals, known).select(*facts.columns, "total_orders")


def earnings_with_distance(
    customer_orders: DataFrame,
    runner_orders: DataFrame,
    premium: Column | None = None,
    sign: int = 1,
    per: str = "line",
) -> DataFrame:
    """Price plus (`sign=-1`: minus) the pay for the distance, per line or once per order."""
    cost = customer_orders.groupBy("order_id").agg(
        F.sum(_price(premium)).alias("price"), F.count(F.lit(1)).alias("lines")
    )
    trips = F.col("lines") if per == "line" else F.lit(1)
    pay = _km() * F.lit(PER_KM).cast("decimal(3,2)") * trips * sign
    return (
        cost.join(_runs(runner_orders, "distance"), "order_id")
        .groupBy("runner_id")
        .agg(F.sum(F.col("price") + pay).cast("decimal(18,4)").alias("TOTAL_EARNED"))
    )


def append_menu_item(
    pizza_names: DataFrame, pizza_recipes: DataFrame, pizza_id: int, name: str, toppings: str
) -> tuple[DataFrame, DataFrame]:
    """Both menu tables with one more pizza."""
    return (
        append_rows(pizza_names, [(pizza_id, name)]),
        append_rows(pizza_recipes, [(pizza_id, toppings)]),
    )
