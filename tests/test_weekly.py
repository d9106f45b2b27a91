from decimal import Decimal

import pytest
from conftest import day, rows, sorted_rows
from pyspark.sql import functions as F

from ledgerloom.functions.dates import short_date, us_week
from ledgerloom.plans import weekly

ROWS = [
    # the pivot week is 25
    ("18/5/20", "ASIA", "Retail", "C1", "New", 10, 1000),
    ("8/6/20", "ASIA", "Shopify", "F2", "Guest", 5, 600),
    ("15/6/20", "ASIA", "Retail", "C4", "New", 3, 700),
    ("22/6/20", "EUROPE", "Shopify", "null", "Existing", 0, 500),
    ("15/4/19", "EUROPE", "Retail", "F1", "Existing", 7, 333),
    ("27/12/18", "EUROPE", "Retail", "X9", "Guest", 3, 10),
]


@pytest.fixture(scope="module")
def clean(table):
    return weekly.clean_weekly_sales(table("weekly_sales", ROWS))


def test_cleaning(clean):
    found = {r["week_d"]: r for r in clean.collect()}
    first = found[day("2020-05-18")]
    assert (first["week_number"], first["month_number"], first["calendar_year"]) == (21, 5, 2020)
    assert (first["age_band"], first["demographic"]) == ("Young Adults", "Couples")
    assert first["avg_transaction"] == Decimal("10000.00")
    assert found[day("2020-06-22")]["avg_transaction"] is None  # no transactions
    assert found[day("2020-06-22")]["age_band"] == "unknown"
    assert found[day("2018-12-27")]["demographic"] == "unknown"
    assert found[day("2019-04-15")]["avg_transaction"] == Decimal("4757.14")


def test_us_weeks_and_short_years(spark):
    days = {"2020-06-15": 25, "2020-01-01": 1, "2020-01-04": 1, "2020-01-05": 2,
            "2021-01-03": 2, "2020-12-31": 53, "2022-12-31": 53}
    df = spark.createDataFrame([(day(d),) for d in days], "d date")
    assert {str(r[0]): r[1] for r in df.select("d", us_week(F.col("d"))).collect()} == days
    texts = {"1/2/49": "2049-02-01", "1/2/50": "1950-02-01", "29/2/96": "1996-02-29",
             "29/02/00": "2000-02-29"}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r[0]: str(r[1]) for r in df.select("t", short_date(F.col("t"))).collect()} == texts


def test_lists(clean):
    assert sorted_rows(weekly.weekday_names(clean)) == [("Monday",), ("Thursday",)]
    present = [r[0] for r in rows(weekly.week_numbers_present(clean))]
    assert present == [16, 21, 24, 25, 26, 52]
    missing = [r[0] for r in rows(weekly.missing_weeks(clean))]
    assert missing == [w for w in range(1, 54) if w not in present]


def test_shares_leave_an_empty_bucket_null(clean):
    shares = {r[0:2]: r[2:] for r in rows(weekly.platform_share_month(clean))}
    assert shares[(2020, 5)] == (Decimal("100.00"), None)
    # 700 of 1800 and 1100 of 1800
    assert shares[(2020, 6)] == (Decimal("38.89"), Decimal("61.11"))


def test_retail_share_drops_the_fraction(clean):
    shares = {r[0:2]: r[2] for r in rows(weekly.retail_share_by_segment(clean))}
    assert shares[("Young Adults", "Couples")] == 48  # 100000 // 2043
    assert shares[("unknown", "unknown")] == 0


def test_transaction_average(clean):
    averages = {r[0:2]: r[2:] for r in rows(weekly.avg_transaction_compare(clean))}
    assert averages[(2020, "Retail")] == (130, Decimal("16666.67"))
    assert averages[(2020, "Shopify")] == (220, Decimal("12000.00"))


def test_before_after(clean):
    # weeks 21-24 hold 1600, weeks 25-28 hold 1200
    assert rows(weekly.before_after_4w(clean, "2020-06-15")) == [(-400, Decimal("0.75"))]
    assert rows(weekly.before_after_12w(clean, "2020-06-15")) == [("After", 1200, 1933)]
    same = weekly.before_after_12w(clean, "2020-06-15", same_year=True)
    assert rows(same) == [("After", 1200, 1600)]
    years = weekly.before_after_vs_years(clean, "2020-06-15", (2018, 2019))
    assert sorted_rows(years) == [
        ("2018", Decimal("120.00000"), Decimal("193.30000")),
        ("2019", Decimal("3.60360"), Decimal("5.80480")),
    ]


def test_no_pivot_week_gives_no_row(clean):
    assert rows(weekly.before_after_4w(clean, "2020-07-06")) == []


def test_impact(clean):
    assert rows(weekly.impact(clean, "platform")) == [("Retail", Decimal("-47.49"))]
    worst = rows(weekly.worst_area_union(clean))
    assert len(worst) == 5
    for dim, area in zip(weekly.DIMENSIONS, [rows(weekly.impact(clean, d))[0] for d in weekly.DIMENSIONS]):
        assert area in worst, dim
