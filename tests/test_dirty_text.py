"""Text that is not what its column promises never ends a job."""

from __future__ import annotations

from decimal import Decimal

from conftest import day, moment, rows, sorted_rows

from ledgerloom.plans import delivery, segments


def runs(table, *changes):
    base = ("2020-01-01 18:15:34", "20km", "32 minutes", None)
    return table("runner_orders", [(i, 1, *(c if c else base)) for i, c in enumerate(changes, start=1)])


def orders(table, n):
    return table(
        "customer_orders",
        [(i, 100 + i, 1, None, None, moment("2020-01-01 18:05:02")) for i in range(1, n + 1)],
    )


def test_fractional_minutes(table):
    found = runs(table, ("2020-01-01 18:15:34", "25 km", "12.5 minutes", None), None)
    assert sorted_rows(delivery.avg_speed(found)) == [(1, 1, Decimal("120.00")), (2, 1, Decimal("37.80"))]
    assert sorted_rows(delivery.duration_spread(found)) == [(1, 20, 0), (2, 0, 20)]
    assert [r[1] for r in sorted_rows(delivery.order_total_time(orders(table, 2), found))] == [22, 42]


def test_bad_pickup_time(table):
    found = runs(table, ("yesterday", "20km", "a while", None), None)
    lines = orders(table, 2)
    assert rows(delivery.avg_pickup_minutes(lines, found)) == [(1, 10)]
    assert sorted_rows(delivery.prep_time_vs_items(lines, found)) == [(1, None, 1), (2, 10, 1)]
    assert sorted_rows(delivery.order_total_time(lines, found)) == [(1, None), (2, 42)]
    fact = {r["order_id"]: r["time_between_order_and_pickup"] for r in delivery.delivery_fact(lines, found).collect()}
    assert fact == {1: None, 2: 10}


def test_list_elements_are_numbers(table):
    lines = table("customer_orders", [(1, 1, 1, "04", " 1 ,x", moment("2020-01-01 18:05:02"))])
    recipes = table("pizza_recipes", [(1, "1, 4, 05")])
    toppings = table("pizza_toppings", [(1, "Bacon"), (4, "Cheese"), (5, "Chicken")])
    used = {r["topping_name"]: r["times_used"] for r in delivery.ingredient_usage(lines, recipes, toppings).collect()}
    assert used == {"Bacon": 2, "Cheese": 0, "Chicken": 1}


def test_interest_id_that_is_no_number(table):
    metrics = table(
        "interest_metrics",
        [("07-2018", "12", Decimal(1), Decimal(1), 1, Decimal(1)), ("07-2018", "n/a", Decimal(2), Decimal(1), 2, Decimal(2))],
    )
    names = table("interest_map", [(12, "A", "", day("2018-08-01"), day("2018-08-01"))])
    dated = segments.month_year_to_date(metrics)
    assert {r["interest_id"]: r["interest_name"] for r in segments.joined_interest(dated, names).collect()} == {
        "12": "A", "n/a": None,
    }
    assert [r["interest_id"] for r in segments.month_before_created(dated, names).collect()] == ["12"]
    segments.reconcile_ids(dated, names).collect()
