from decimal import Decimal

import pytest
from conftest import moment, rows, sorted_rows

from ledgerloom.plans import clickstream as click
from ledgerloom.sources import clickstream as source

# visit, cookie, page, type, time
LOG = [
    ("v1", "c1", 1, 1, "2024-01-02 10:00:00"),
    ("v1", "c1", 3, 1, "2024-01-02 10:01:00"),
    ("v1", "c1", 3, 2, "2024-01-02 10:02:00"),
    ("v1", "c1", 5, 2, "2024-01-02 10:02:30"),
    ("v1", "c1", 12, 1, "2024-01-02 10:03:00"),
    ("v1", "c1", 13, 3, "2024-01-02 10:04:00"),
    ("v2", "c2", 3, 1, "2024-01-12 09:00:00"),
    ("v2", "c2", 3, 2, "2024-01-12 09:01:00"),
    ("v2", "c2", 4, 4, "2024-01-12 09:02:00"),
    ("v2", "c2", 12, 1, "2024-01-12 09:03:00"),
    ("v3", "c3", 5, 1, "2024-01-29 23:00:00"),
    ("v4", "c1", 1, 1, "2024-01-21 08:00:00"),
    ("v5", "c1", 3, 5, "2024-01-28 23:59:59"),
    ("v5", "c1", 13, 3, "2024-01-28 23:59:59"),
]
USERS = [(1, "c1"), (1, "c3"), (2, "c2")]


@pytest.fixture(scope="module")
def log(table):
    return table("site_events", [(*r[:4], moment(r[4])) for r in LOG])


@pytest.fixture(scope="module")
def users(table):
    return table("users", USERS)


@pytest.fixture(scope="module")
def pages(spark):
    return source.page_hierarchy(spark)


@pytest.fixture(scope="module")
def campaign_inputs(spark, log, users, pages):
    return log, users, pages, source.campaign_identifier(spark)


def test_counts(log, users, pages):
    assert rows(click.user_count(users)) == [(2,)]
    assert rows(click.avg_cookies(users)) == [(Decimal("1.50"),)]
    assert rows(click.visits_by_month(log)) == [(1, 5)]
    assert rows(click.events_by_type(log)) == [(1, 7), (2, 3), (3, 2), (4, 1), (5, 1)]
    assert rows(click.top_pages(log, pages, 1)) == [("Checkout", 2)]


def test_shares(log):
    assert rows(click.purchase_pct(log)) == [(Decimal("40.00"),)]
    assert rows(click.checkout_no_purchase(log)) == [(Decimal("50.00"),)]


def test_categories(spark, log, pages):
    kinds = source.event_identifier(spark)
    assert rows(click.category_views_adds(log, pages, kinds)) == [("Fish", 3, 3)]
    every = click.category_views_adds(log, pages, kinds, keep_all=True)
    assert sorted_rows(every) == [("Fish", 3, 3)]


def test_funnel(log, pages):
    assert sorted_rows(click.abandon_counts(log, pages)) == [("Salmon", 1)]
    assert sorted_rows(click.purchase_counts(log, pages)) == [("Salmon", 1), ("Tuna", 1)]
    assert rows(click.top_products(log, pages)) == [("Salmon", 1), ("Tuna", 1)]
    assert rows(click.product_funnel(log, pages)) == [(1, "Salmon", "Fish", 2, 2, 1, 1)]
    every = {r["product_name"]: tuple(r)[3:] for r in
             click.product_funnel(log, pages, keep_all=True).collect()}
    assert every["Tuna"] == (1, 1, 0, 1)
    assert all(adds == left + bought for _, adds, left, bought in every.values())
    assert sorted_rows(click.category_funnel(log, pages)) == [("Fish", 2, 2, 1, 1)]
    assert sorted_rows(click.funnel_leaders(log, pages)) == [
        ("Most Cart Add", "Salmon", 2), ("Most Purchases", "Salmon", 1), ("Most Viewed", "Salmon", 2)
    ]
    assert rows(click.view_purchase_ratio(log, pages)) == [("Salmon", Decimal("2.00"))]
    assert rows(click.view_to_cart_rate(log, pages)) == [(Decimal("100.00"),)]
    assert rows(click.cart_to_purchase_rate(log, pages)) == [(Decimal("50.00"),)]


def test_campaign_visits(campaign_inputs):
    visits = {r["visit_id"]: r for r in click.campaign_visits(*campaign_inputs).collect()}
    # v3 lies outside all campaigns, v4 saw no product page
    assert set(visits) == {"v1", "v2", "v5"}
    assert visits["v1"]["cart_prod"] == "Salmon, Salmon, Tuna"
    assert visits["v1"]["campaign_name"] == "Early January"
    assert (visits["v1"]["view_count"], visits["v1"]["cart_count"]) == (3, 2)
    assert visits["v5"]["campaign_name"] == "Late January" and visits["v5"]["click"] == 1
    assert visits["v2"]["visit_start_time"] == moment("2024-01-12 09:00:00")


def test_overlapping_campaigns_fan_out(spark, log, users, pages, table):
    campaigns = table("campaign_identifier", [
        ("a", moment("2024-01-01 00:00:00"), moment("2024-01-02 10:02:00")),
        ("b", moment("2024-01-02 10:01:30"), moment("2024-01-02 23:00:00")),
    ])
    facts = click.campaign_visits(log, users, pages, campaigns)
    counts = {r["campaign_name"]: (r["view_count"], r["cart_count"]) for r in facts.collect()}
    assert counts == {"a": (2, 1), "b": (1, 2)}


def test_cohorts(campaign_inputs):
    assert rows(click.users_in_all_campaigns(*campaign_inputs)) == []
    assert rows(click.users_in_all_campaigns(*campaign_inputs, n=1)) == [(2, 1)]
    cohorts = {r[0]: tuple(r)[1:] for r in click.impressed_vs_not(*campaign_inputs, n=1).collect()}
    # user 1 has visits v1 and v5: (3 + 0) div 2 views, (2 + 0) div 2 adds
    assert cohorts == {"imp_user": (2, 1, Decimal(0)), "non_imp_user": (1, 1, Decimal(1))}
    assert sorted_rows(click.click_purchase_rate(*campaign_inputs)) == [
        ("click_user", Decimal("100.000000")), ("non_click_user", Decimal("0.000000"))
    ]
    assert sorted_rows(click.campaign_uplift(*campaign_inputs)) == [
        ("click_user", Decimal("33.333300")), ("non_click_user", Decimal("0.000000")),
        ("non_impression_user", Decimal("66.666600")),
    ]
