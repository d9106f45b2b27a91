from decimal import Decimal

import pytest
from conftest import day, rows, sorted_rows

from ledgerloom.plans import segments as seg

# month, interest, composition, index, ranking, percentile
RAW = [
    ("07-2018", "1", "10.00", "2.00", 1, "90.00"),
    ("08-2018", "1", "9.00", "2.00", 2, "50.00"),
    ("09-2018", "1", "8.00", "1.00", 1, "95.00"),
    ("07-2018", "2", "6.00", "1.00", 2, "60.00"),
    ("08-2018", "2", "9.00", "1.00", 1, "61.00"),
    ("07-2018", "3", "10.00", "4.00", 3, "10.00"),
    (None, "3", "1.00", "1.00", 1, "1.00"),
    ("09-2018", "5", "3.00", "1.00", 2, "20.00"),
]
MAP = [
    (1, "One", "first", day("2018-07-15"), day("2018-08-15")),
    (2, "Two", "second", day("2018-01-01"), day("2018-08-15")),
    (3, "Three", "third", day("2018-01-01"), day("2018-08-15")),
    (4, "Four", "unused", day("2018-01-01"), day("2018-08-15")),
]


@pytest.fixture(scope="module")
def raw(table):
    data = [(m, i, Decimal(c), Decimal(x), r, Decimal(p)) for m, i, c, x, r, p in RAW]
    return seg.month_year_to_date(table("interest_metrics", data))


@pytest.fixture(scope="module")
def metrics(raw):
    return seg.drop_null_months(raw)


@pytest.fixture(scope="module")
def interests(table):
    return table("interest_map", MAP)


def test_cleaning(raw, metrics):
    assert {r["month_year"] for r in metrics.collect()} == {
        day("2018-07-01"), day("2018-08-01"), day("2018-09-01")
    }
    assert rows(seg.records_by_month(raw)) == [
        (None, 1), (day("2018-09-01"), 2), (day("2018-08-01"), 2), (day("2018-07-01"), 3)
    ]
    oldest = rows(seg.records_by_month(raw, order="oldest"))
    assert oldest[0] == (None, 1) and oldest[1] == (day("2018-07-01"), 3)
    assert rows(seg.null_month_count(raw)) == [(1,)]
    assert rows(seg.null_month_count(metrics)) == [(0,)]


def test_keys(metrics, interests):
    assert rows(seg.reconcile_ids(metrics, interests)) == [(1, 1)]
    assert rows(seg.map_count(interests)) == [(4,)]
    one = rows(seg.joined_interest(metrics, interests, "5"))
    assert len(one) == 1 and one[0][-4:] == (None,) * 4
    early = rows(seg.month_before_created(metrics, interests))
    assert [(r[0], r[1]) for r in early] == [(day("2018-07-01"), "1")]


def test_coverage(metrics):
    assert rows(seg.always_present(metrics)) == [(1,)]
    # one interest has 3 months, one has 2, two have 1
    assert sorted_rows(seg.cumulative_pct(metrics, 50)) == [
        (1, 2, Decimal("100.00")), (2, 1, Decimal("50.00"))
    ]
    assert rows(seg.rows_below_threshold(metrics, 2)) == [(2,)]
    assert rows(seg.interests_per_month(metrics, 1)) == [
        (day("2018-07-01"), 2), (day("2018-08-01"), 2), (day("2018-09-01"), 1)
    ]
    assert seg.filtered_metrics(metrics, 2).count() == 5
    below = rows(seg.rows_below_threshold(metrics, 2))[0][0]
    assert below + seg.filtered_metrics(metrics, 2).count() == metrics.count()


def test_extremes_keep_ties(metrics, interests):
    top = sorted_rows(seg.extreme_composition(metrics, interests, n=3).select("interest_id", "composition", "rn"))
    assert top == [
        ("1", Decimal("10.00"), 1), ("1", Decimal("9.00"), 3),
        ("2", Decimal("9.00"), 3), ("3", Decimal("10.00"), 1),
    ]
    low = seg.extreme_composition(metrics, interests, lowest=True, n=1)
    assert [r["composition"] for r in low.collect()] == [Decimal("6.00")]
    peaks = seg.extreme_composition(metrics, interests, per_interest=True)
    assert sorted_rows(peaks.select("interest_id", "month_year", "rn")) == [
        ("1", day("2018-07-01"), 1), ("2", day("2018-08-01"), 3), ("3", day("2018-07-01"), 1)
    ]


def test_rankings(metrics, interests):
    assert rows(seg.worst_ranking5(metrics, interests)) == [
        ("Three", Decimal("3.00")), ("Two", Decimal("1.50")), ("One", Decimal("1.33"))
    ]
    # sample deviation of 90, 50, 95 and of 60, 61; one row has none
    assert rows(seg.most_variable5(metrics, interests)) == [
        ("One", Decimal("24.66")), ("Two", Decimal("0.71")), ("Three", None)
    ]
    ends = seg.percentile_extremes(metrics, interests)
    assert rows(ends) == [
        (day("2018-09-01"), "One", Decimal("95.00")), (day("2018-07-01"), "Three", Decimal("10.00"))
    ]
    own = sorted_rows(seg.percentile_extremes(metrics, interests, per_interest=True))
    assert len(own) == 5


def test_index(metrics, interests):
    top = {(r["month_year"].month, r["interest_id"]): (r["avg_comp"], r["rn"])
           for r in seg.monthly_top10(metrics, interests).collect()}
    assert top[(7, "2")] == (Decimal("6.00"), 1) and top[(7, "1")] == (Decimal("5.00"), 2)
    assert (9, "5") not in top  # not in the map
    assert rows(seg.most_frequent_top10(metrics, interests)) == [("One", 3)]
    average = dict(rows(seg.avg_of_avg_comp(metrics, interests)))
    assert average[day("2018-07-01")] == Decimal("4.500000")


def test_rolling(metrics, interests):
    assert rows(seg.rolling3_with_leaders(metrics, interests, "2018-07-01")) == [
        (day("2018-08-01"), "Two", Decimal("9.00"), Decimal("7.50"), "Two : 6.00", " : "),
        (day("2018-09-01"), "One", Decimal("8.00"), Decimal("7.67"), "Two : 9.00", "Two : 6.00"),
    ]
