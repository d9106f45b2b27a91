"""Hand-derived answers on the small delivery tables."""

from decimal import Decimal

from conftest import moment, rows, sorted_rows

from ledgerloom.plans import delivery


def pick(kitchen, names):
    return [kitchen[n] for n in names.split()]


BOTH = "customer_orders runner_orders"
MENU = "pizza_recipes pizza_toppings"


def as_dict(df):
    return {r[0]: r[1] for r in df.collect()}


def test_counts(kitchen):
    assert rows(delivery.items_ordered(kitchen["customer_orders"])) == [(14,)]
    assert rows(delivery.unique_customers(kitchen["customer_orders"])) == [(5,)]
    assert rows(delivery.successful_orders(kitchen["runner_orders"])) == [(8,)]
    per_runner = delivery.successful_orders(kitchen["runner_orders"], per_runner=True)
    assert as_dict(per_runner) == {1: 4, 2: 3, 3: 1}


def test_delivered_by_type(kitchen):
    assert as_dict(delivery.delivered_by_type(*pick(kitchen, BOTH))) == {1: 9, 2: 3}


def test_max_items(kitchen):
    assert rows(delivery.max_items_per_order(kitchen["customer_orders"])) == [(4, 3)]


def test_changes(kitchen):
    assert as_dict(delivery.changes_per_customer(*pick(kitchen, BOTH))) == {103: 3, 104: 5, 105: 1}
    assert rows(delivery.both_changes_count(*pick(kitchen, BOTH))) == [(1,)]


def test_a_null_among_the_cancelled_orders_empties_the_result(kitchen, table):
    cancelled = [(None, 1, "null", "null", "null", ""), (1, 1, "null", "null", "null", "")]
    runs = table("runner_orders", cancelled)
    assert rows(delivery.delivered_by_type(kitchen["customer_orders"], runs)) == []


def test_signups(kitchen):
    assert as_dict(delivery.signups_by_week(kitchen["runners"])) == {1: 1, 2: 2, 3: 1}


def test_pickup_minutes(kitchen):
    assert as_dict(delivery.avg_pickup_minutes(*pick(kitchen, BOTH))) == {1: 15, 2: 23, 3: 10}


def test_prep_time(kitchen):
    result = rows(delivery.prep_time_vs_items(*pick(kitchen, BOTH)))
    assert [r[2] for r in result] == [1, 1, 1, 1, 1, 2, 2, 3]
    assert (4, 29, 3) in result and (3, 21, 2) in result


def test_avg_distance(kitchen):
    expected = {101: "20.00", 102: "16.73", 103: "23.40", 104: "10.00", 105: "25.00"}
    assert as_dict(delivery.avg_distance(*pick(kitchen, BOTH))) == {
        k: Decimal(v) for k, v in expected.items()
    }
    once = as_dict(delivery.avg_distance(*pick(kitchen, BOTH), per="order"))
    assert once[102] == Decimal("18.40")


def test_duration_spread(kitchen):
    spread = {r[0]: (r[1], r[2]) for r in delivery.duration_spread(kitchen["runner_orders"]).collect()}
    assert spread[4] == (0, 30) and spread[10] == (30, 0) and len(spread) == 8


def test_speed_rounds_before_the_hour_step(kitchen):
    speed = {r["order_id"]: r["avg_speed"] for r in
             delivery.avg_speed(kitchen["runner_orders"]).collect()}
    # 20 / 32 = 0.625, rounded to 0.63 first
    assert speed[1] == Decimal("37.80") and speed[10] == Decimal("60.00")


def test_delivery_pct(kitchen):
    share = {r[0]: tuple(r[1:]) for r in delivery.delivery_pct(kitchen["runner_orders"]).collect()}
    assert share == {1: (4, 4, 100), 2: (3, 4, 75), 3: (1, 2, 50)}
    written = delivery.delivery_pct(kitchen["runner_orders"], as_written=True)
    assert {r[0]: tuple(r[1:]) for r in written.collect()} == {
        1: (3, 4, 75), 2: (3, 4, 75), 3: (1, 2, 50)
    }


def test_clean_orders_numbers_equal_rows_apart(kitchen):
    records = delivery.clean_orders(kitchen["customer_orders"]).collect()
    assert len(records) == 14 and len({r["record_id"] for r in records}) == 14
    assert {r["record_id"] for r in records if r["order_id"] == 4} == {"4-1", "4-2", "4-3"}
    assert {r["extras"] for r in records} == {None, "1", "1, 5", "1, 4"}
    assert {r["exclusions"] for r in records} == {None, "4", "2, 6"}


def test_list_rows(kitchen):
    extras = sorted_rows(delivery.explode_extras(kitchen["customer_orders"]))
    assert extras == [
        ("10-2", 10, "1"), ("10-2", 10, "4"), ("5-1", 5, "1"), ("7-1", 7, "1"),
        ("9-1", 9, "1"), ("9-1", 9, "5"),
    ]
    assert delivery.explode_exclusions(kitchen["customer_orders"]).count() == 6


def test_top_lists(kitchen):
    assert rows(delivery.top_extra(kitchen["customer_orders"])) == [(1, 4)]
    assert rows(delivery.top_exclusion(kitchen["customer_orders"])) == [(4, 4)]


def test_recipes(kitchen):
    standard = sorted_rows(delivery.standard_ingredients(*pick(kitchen, MENU)))
    assert len(standard) == 14 and standard[0] == (1, 1, "Bacon")
    cleaned = sorted_rows(delivery.cleaned_toppings(*pick(kitchen, MENU)))
    assert cleaned[0] == (1, "1", "Bacon")


def test_descriptions(kitchen):
    text = as_dict(
        delivery.order_description(
            *pick(kitchen, "customer_orders pizza_names pizza_toppings")
        )
    )
    assert text["1-1"] == "Meatlovers"
    assert text["9-1"] == "Meatlovers - Extra Bacon, Chicken - Exclude Cheese"
    assert text["10-2"] == "Meatlovers - Extra Bacon, Cheese - Exclude BBQ Sauce, Mushrooms"


def test_ingredients(kitchen):
    usage = as_dict(delivery.ingredient_usage(*pick(kitchen, f"customer_orders {MENU}")))
    # ten meat pizzas: bacon is an extra on three of them
    assert usage["Bacon"] == 13 and usage["Cheese"] == 11 and usage["Onions"] == 4
    delivered = as_dict(
        delivery.ingredient_usage_delivered(*pick(kitchen, f"{BOTH} {MENU}"), delivered_only=True)
    )
    assert delivered["Onions"] == 3
    lists = as_dict(delivery.ingredient_list(*pick(kitchen, f"customer_orders {MENU}")))
    assert lists["10-2"] == "2xBacon, Beef, 2xCheese, Chicken, Pepperoni, Salami"


def test_revenue(kitchen):
    assert as_dict(delivery.revenue_per_runner(*pick(kitchen, BOTH))) == {1: 70, 2: 56, 3: 12}
    assert as_dict(delivery.revenue_with_extras(*pick(kitchen, BOTH))) == {1: 72, 2: 57, 3: 13}


def test_total_time(kitchen):
    assert as_dict(delivery.order_total_time(*pick(kitchen, BOTH)))[1] == 42


def test_ratings(kitchen):
    ratings = rows(delivery.runner_ratings(*pick(kitchen, BOTH)))
    assert len(ratings) == 12 and all(1 <= r[3] <= 5 and 1 <= r[4] <= 5 for r in ratings)
    assert {r[0]: r[2] for r in ratings} == {1: 3, 2: 3, 3: 4, 4: 2, 5: 5, 7: 4, 8: 5, 10: 5}
    once = delivery.runner_ratings(*pick(kitchen, BOTH), per="order")
    assert once.count() == 8


def test_delivery_fact(kitchen):
    facts = delivery.delivery_fact(*pick(kitchen, BOTH)).collect()
    assert len(facts) == 8
    first = next(f for f in facts if f["order_id"] == 1)
    assert first["total_orders"] == 3 and first["time_between_order_and_pickup"] == 10
    assert first["order_time"] == moment("2020-01-01 18:05:02")


def test_earnings(kitchen):
    # 20, 20, 13.4 twice and 10 twice for runner 1
    plus = as_dict(delivery.earnings_with_distance(*pick(kitchen, BOTH)))
    assert plus[1] == Decimal("70") + Decimal("0.3") * Decimal("86.8")
    minus = as_dict(
        delivery.earnings_with_distance(*pick(kitchen, BOTH), sign=-1, per="order")
    )
    assert minus[1] == Decimal("70") - Decimal("0.3") * Decimal("63.4")


def test_append_menu_item(kitchen):
    names, recipes = delivery.append_menu_item(
        *pick(kitchen, "pizza_names pizza_recipes"), 3, "Supreme", "1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12"
    )
    assert sorted_rows(names)[-1] == (3, "Supreme") and recipes.count() == 3
    standard = delivery.standard_ingredients(recipes, kitchen["pizza_toppings"])
    assert standard.filter("pizza_id = 3").count() == 12
