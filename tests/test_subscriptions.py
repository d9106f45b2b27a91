"""Small customer journeys with answers worked out by hand."""

from decimal import Decimal

import pytest
from conftest import day, rows, sorted_rows

from ledgerloom.plans import subscriptions as subs
from ledgerloom.sources import subscriptions as source

JOURNEYS = [
    (1, 0, "2020-08-01"), (1, 1, "2020-08-08"),
    (2, 0, "2020-09-20"), (2, 3, "2020-09-27"),
    (4, 0, "2020-01-17"), (4, 1, "2020-01-24"), (4, 4, "2020-04-21"),
    (6, 0, "2020-12-23"), (6, 1, "2020-12-30"), (6, 4, "2021-02-26"),
    (7, 0, "2020-02-05"), (7, 1, "2020-02-12"), (7, 2, "2020-05-22"),
    (9, 0, "2020-12-07"), (9, 4, "2020-12-14"),
    (10, 0, "2020-03-01"), (10, 2, "2020-03-08"), (10, 1, "2020-06-08"),
]


@pytest.fixture(scope="module")
def data(spark, table):
    plans = source.plans(spark)
    return table("subscriptions", [(c, p, day(d)) for c, p, d in JOURNEYS]), plans


def test_journey(data):
    journey = rows(subs.customer_journey(*data, below=5))
    assert len(journey) == 7
    assert (2, 3, "pro annual", Decimal("199.00"), day("2020-09-27")) in journey


def test_counts(data):
    assert rows(subs.total_customers(data[0])) == [(7,)]
    assert rows(subs.trials_by_month(data[0]))[0] == (1, 1)
    assert rows(subs.events_before_after_cutoff(*data, cutoff="2021-01-01")) == [
        (0, "trial", 7, 0), (1, "basic monthly", 5, 0), (2, "pro monthly", 2, 0),
        (3, "pro annual", 1, 0), (4, "churn", 2, 1),
    ]


def test_churn(data):
    assert rows(subs.churn_pct(data[0])) == [(3, Decimal("42.9"))]
    assert rows(subs.churn_after_trial(*data)) == [(1, Decimal("14"))]


def test_next_plan(data):
    assert rows(subs.next_plan_after_trial(*data)) == [
        (1, 5, Decimal("71.4")), (3, 1, Decimal("14.3")), (4, 1, Decimal("14.3"))
    ]
    by_date = {r[0]: r[1] for r in
               subs.next_plan_after_trial(*data, order="start_date").collect()}
    assert by_date == {1: 4, 2: 1, 3: 1, 4: 1}


def test_plan_mix(data):
    mix = {r[0]: r[1] for r in subs.plan_mix_at_date(data[0], "2020-12-31").collect()}
    assert mix == {1: 3, 2: 1, 3: 1, 4: 2}


def test_a_start_on_the_day_itself_is_lost_as_written(table):
    one = table("subscriptions", [(1, 0, day("2020-12-24")), (1, 1, day("2020-12-31"))])
    assert rows(subs.plan_mix_at_date(one, "2020-12-31"))[0][:2] == (0, 1)
    inclusive = subs.plan_mix_at_date(one, "2020-12-31", as_written=False)
    assert rows(inclusive)[0][:2] == (1, 1)


def test_upgrades_and_downgrades(data):
    assert rows(subs.annual_upgrades(*data, year=2020)) == [(1,)]
    assert rows(subs.downgrades(*data, year=2020)) == [(0,)]
    assert rows(subs.downgrades(*data, year=2020, order="start_date")) == [(1,)]


def test_days_to_annual(data, table):
    assert rows(subs.avg_days_to_annual(data[0])) == [(7,)]
    assert rows(subs.days_to_annual_histogram(data[0])) == [(1, "0-30")]
    more = table("subscriptions", [
        (1, 0, day("2020-01-01")), (1, 3, day("2020-01-31")),
        (2, 0, day("2020-01-01")), (2, 3, day("2020-03-02")),
    ])
    assert rows(subs.days_to_annual_histogram(more)) == [(1, "30-60"), (1, "60-90")]


def test_payments(data):
    paid = rows(subs.payment_schedule(*data, year=2020))
    four = [(p[3], p[5]) for p in paid if p[0] == 4]
    assert four == [(day("2020-01-24"), 1), (day("2020-02-24"), 2), (day("2020-03-24"), 3)]
    assert [p for p in paid if p[0] == 2] == [
        (2, 3, "pro annual", day("2020-09-27"), Decimal("199.00"), 1)
    ]
    seven = [(p[1], p[3]) for p in paid if p[0] == 7]
    assert seven[:4] == [(1, day(f"2020-{m:02d}-12")) for m in (2, 3, 4, 5)]
    assert seven[-1] == (2, day("2020-12-22"))
    assert not [p for p in paid if p[0] == 9]


def test_a_day_cut_at_a_short_month_stays_cut(spark, table):
    one = table("subscriptions", [(1, 1, day("2020-01-31"))])
    paid = [r[3] for r in rows(subs.payment_schedule(one, source.plans(spark), year=2020))]
    assert paid[:4] == [day("2020-01-31"), day("2020-02-29"), day("2020-03-29"), day("2020-04-29")]
    assert len(paid) == 12


def test_payments_cross_the_year(spark, table):
    one = table("subscriptions", [(1, 1, day("2019-11-15"))])
    paid = [r[3] for r in rows(subs.payment_schedule(one, source.plans(spark), year=2020))]
    assert paid[0] == day("2020-01-15") and len(paid) == 12


def test_month_ratios(data):
    ratios = {r[0]: r[1] for r in subs.pro_plan_month_ratio(*data, year=2020).collect()}
    assert ratios == {3: Decimal("0.00"), 5: Decimal("1.00"), 9: Decimal("1.00")}
    new = {r[0]: r[1] for r in subs.new_customers_by_month(*data, year=2020).collect()}
    assert new == {1: 1, 2: 1, 3: 1, 8: 1, 9: 1, 12: 1}
    churned = {r[0]: r[1] for r in subs.churn_by_month(*data, year=2020).collect()}
    assert churned == {4: 1, 12: 1}
    assert rows(subs.new_to_churn_ratio(*data, year=2020)) == [(12, Decimal("1.00"))]
    every = subs.new_to_churn_ratio(*data, year=2020, keep_all=True)
    assert dict(rows(every))[1] is None and dict(rows(every))[4] == 0


def test_churn_by_plan(data):
    assert sorted_rows(subs.churn_by_from_plan(*data)) == [(0, 1), (1, 2)]
