"""Jobs that write, declared inputs, and numbering and schedules at their limits."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import timedelta
from decimal import Decimal

import pytest
from conftest import day, moment, rows, sorted_rows

from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from ledgerloom import jobs
from ledgerloom.operators import positions
from ledgerloom.operators.state import billing_schedule
from ledgerloom.plans import clickstream, delivery, loyalty, subscriptions
from ledgerloom.registry import QUERIES
from ledgerloom.sources import tables
from ledgerloom.sources.sinks import append_rows

FOLDER = entry_points.SMOKE_FOLDER


def test_clean_sales_are_stored_by_year(spark, tmp_path):
    path = str(tmp_path / "sales")
    for _ in range(2):
        jobs.store_clean_sales(spark, FOLDER, path)
        stored = spark.read.parquet(path)
        expected = QUERIES["w01_clean_weekly_sales"](spark, FOLDER)
        assert sorted_rows(stored.select(*expected.columns)) == sorted_rows(expected)
    assert {p.name.split("=")[0] for p in (tmp_path / "sales").iterdir() if p.is_dir()} == {"calendar_year"}


def test_ratings_are_appended_to_the_declared_table(spark, tmp_path):
    path = str(tmp_path / "ratings")
    for _ in range(2):
        jobs.store_ratings(spark, FOLDER, path)
        assert sorted_rows(spark.read.parquet(path)) == sorted_rows(QUERIES["d31_runner_ratings"](spark, FOLDER))
    assert spark.read.parquet(path).columns == [f.split()[0] for f in jobs.RATINGS.split(", ")]


def test_inputs_are_the_declared_ones(spark):
    wrong = spark.createDataFrame([(1, "x")], "customer_id bigint, join_date string")
    with pytest.raises(TypeError):
        tables.declared(wrong, "members")


def test_literal_rows(spark):
    df = spark.createDataFrame([(1, "a")], "k bigint, v string")
    more = append_rows(df, [(2, None), (3, "c")])
    assert sorted_rows(more) == [(1, "a"), (2, None), (3, "c")] and more.schema == df.schema
    assert "Scan ExistingRDD" not in append_rows(spark.range(1), [(2,)])._jdf.queryExecution().toString()


def test_record_ids_agree_when_copies_are_cut(spark, table, monkeypatch):
    monkeypatch.setattr(positions, "COPIES_PER_TASK", 2)
    at = moment("2020-01-01 18:05:02")
    lines = [(7, 1, 3, None, None, at)] * 5 + [(7, 2, 3, None, None, at)] * 5 + [(7, 2, 4, None, "1, 5", at)]
    orders = table("customer_orders", lines)
    whole = {r["record_id"]: (r["pizza_id"], r["extras"]) for r in delivery.clean_orders(orders).collect()}
    assert len(whole) == 11 and whole["7-11"] == (4, "1, 5")
    assert sorted_rows(delivery.explode_extras(orders)) == [("7-11", 7, "1"), ("7-11", 7, "5")]


def test_member_rank_when_copies_are_cut(spark, table, monkeypatch):
    monkeypatch.setattr(positions, "COPIES_PER_TASK", 2)
    start = day("2021-01-10")
    draw = random.Random(1)
    sales = [(draw.randrange(3), start + timedelta(draw.randrange(-2, 3)), draw.randrange(1, 4)) for _ in range(200)]
    menu = [(p, f"p{p}", Decimal(p)) for p in range(1, 4)]
    found = loyalty.member_order_rank(
        table("sales", sales), table("menu", menu), table("members", [(0, start), (1, start)])
    )
    expected = []
    by_customer = defaultdict(int)
    for c, d, p in sorted(sales):
        if c < 2 and d >= start:
            by_customer[c] += 1
        expected.append((c, d, f"p{p}", by_customer[c] if c < 2 and d >= start else None))
    assert sorted(map(repr, expected)) == sorted(
        repr((r["Customer"], r["order_date"], r["product_name"], r["ranking"])) for r in found.collect()
    )


def plain_schedule(start, end, repeats):
    def add(d, n):
        month = d.month - 1 + n
        year, month = d.year + month // 12, month % 12 + 1
        last = (day(f"{year + month // 12}-{month % 12 + 1:02d}-01") - timedelta(1)).day
        return day(f"{year}-{month:02d}-{min(d.day, last):02d}")

    out = [start]
    while repeats and out[-1] < add(end, -1):
        out.append(add(out[-1], 1))
    return out


def test_schedule_equals_month_by_month(spark):
    cases = [
        (i, day(s), day(e), r)
        for i, (s, e, r) in enumerate(
            (s, e, r)
            for s in ("2020-01-28", "2020-01-29", "2020-01-30", "2020-01-31", "2019-08-31", "2023-12-31", "2021-03-30")
            for e in ("2020-01-31", "2020-03-31", "2024-02-29", "2040-01-31", "2019-01-01")
            for r in (True, False)
        )
    ]
    df = spark.createDataFrame(cases, "i int, s date, e date, r boolean")
    got = defaultdict(list)
    for r in billing_schedule(df, ["i"], F.col("s"), F.col("e"), F.col("r")).collect():
        got[r["i"]].append(r["payment_date"])
    assert {i: sorted(got[i]) for i, *_ in cases} == {i: plain_schedule(s, e, r) for i, s, e, r in cases}


def test_repeated_starts_take_the_earliest(table):
    """By contract a customer starts a plan once; of repeated starts the earliest counts."""
    rows_ = [(1, 0, day("2020-01-01")), (1, 0, day("2020-02-01")), (1, 3, day("2020-03-01")), (1, 3, day("2020-06-01"))]
    found = subscriptions.avg_days_to_annual(table("subscriptions", rows_))
    assert rows(found) == [(60,)]


def test_visit_with_very_many_events_in_a_minute(spark, table):
    start = moment("2024-01-02 10:00:00")
    events = [("v", "c", 3 + i % 9, 1, start + timedelta(milliseconds=i)) for i in range(5000)]
    pages = table("page_hierarchy", [(p, f"P{p}", "x" if 3 <= p <= 11 else None, p if 3 <= p <= 11 else None) for p in range(1, 14)])
    campaigns = table("campaign_identifier", [("A", moment("2024-01-01 00:00:00"), moment("2024-01-10 00:00:00"))])
    found = clickstream.campaign_visits(
        table("site_events", events), table("users", [(1, "c")]), pages, campaigns
    ).collect()
    assert len(found) == 1 and found[0]["view_count"] == 5000
    assert found[0]["cart_prod"] == ", ".join(f"P{3 + i % 9}" for i in range(5000))
