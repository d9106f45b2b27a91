"""Hand-derived answers on the small restaurant tables (customers A, B, C are 1, 2, 3)."""

from decimal import Decimal

from conftest import day, rows, sorted_rows
from pyspark.sql import functions as F

from ledgerloom.plans import loyalty


def two(restaurant):
    return restaurant["sales"], restaurant["menu"]


def three(restaurant):
    return restaurant["sales"], restaurant["menu"], restaurant["members"]


def as_dict(df):
    return {r[0]: r[1] if len(r) == 2 else tuple(r[1:]) for r in df.collect()}


def test_spend(restaurant):
    assert as_dict(loyalty.spend_per_customer(*two(restaurant))) == {1: 76, 2: 74, 3: 36}


def test_visit_days(restaurant):
    assert as_dict(loyalty.visit_days(restaurant["sales"])) == {1: 4, 2: 6, 3: 2}


def test_first_item_breaks_ties_by_product(restaurant):
    first = as_dict(loyalty.first_item(*two(restaurant)))
    assert first == {1: "sushi", 2: "curry", 3: "ramen"}


def test_most_purchased_item(restaurant):
    assert rows(loyalty.most_purchased_item(*two(restaurant))) == [("ramen", 8)]


def test_favourite_item_keeps_ties(restaurant):
    assert sorted_rows(loyalty.favourite_item(*two(restaurant))) == [
        (1, "ramen"), (2, "curry"), (2, "ramen"), (2, "sushi"), (3, "ramen")
    ]


def test_first_item_after_join(restaurant):
    assert as_dict(loyalty.first_item_after_join(*three(restaurant))) == {1: "curry", 2: "sushi"}


def test_items_before_join(restaurant):
    items = [(1, "curry"), (1, "sushi"), (2, "curry"), (2, "sushi")]
    assert sorted_rows(loyalty.items_before_join(*three(restaurant))) == items
    last = loyalty.items_before_join(*three(restaurant), last_only=True)
    assert sorted_rows(last) == [(1, "curry"), (1, "sushi"), (2, "sushi")]


def test_totals_before_join(restaurant):
    assert as_dict(loyalty.totals_before_join(*three(restaurant))) == {1: (2, 25), 2: (3, 40)}


def test_points(restaurant):
    assert as_dict(loyalty.loyalty_points(*two(restaurant))) == {1: 860, 2: 940, 3: 360}


def test_promo_window(restaurant):
    end = F.lit("2021-01-31").cast("date")
    points = as_dict(loyalty.promo_window_points(*three(restaurant), end=end))
    assert points == {1: 102, 2: 32}


def test_promo_window_gives_null_when_all_sales_lie_outside(restaurant, table):
    members = table("members", [(3, day("2022-01-01"))])
    end = F.lit("2021-01-31").cast("date")
    assert as_dict(loyalty.promo_window_points(*two(restaurant), members, end=end)) == {3: None}


def test_member_flags(restaurant):
    flagged = loyalty.member_flagged_orders(*three(restaurant))
    counts = {(r["Customer"], r["member"]): r["count"] for r in
              flagged.groupBy("Customer", "member").count().collect()}
    assert counts == {(1, "N"): 2, (1, "Y"): 4, (2, "N"): 3, (2, "Y"): 3, (3, "N"): 3}


def test_member_order_rank(restaurant):
    ranked = sorted_rows(loyalty.member_order_rank(*three(restaurant)).filter("Customer = 1"))
    price = {"sushi": Decimal(10), "curry": Decimal(15), "ramen": Decimal(12)}
    expected = [
        ("2021-01-01", "sushi", "N", None), ("2021-01-01", "curry", "N", None),
        ("2021-01-07", "curry", "Y", 1), ("2021-01-10", "ramen", "Y", 2),
        ("2021-01-11", "ramen", "Y", 3), ("2021-01-11", "ramen", "Y", 4),
    ]
    assert ranked == sorted(
        [(1, day(d), n, price[n], m, r) for d, n, m, r in expected], key=repr
    )
    others = loyalty.member_order_rank(*three(restaurant)).filter("Customer = 3")
    assert [r["ranking"] for r in others.collect()] == [None] * 3
