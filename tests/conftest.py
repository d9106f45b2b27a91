from __future__ import annotations

import sys
from datetime import date, datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from ledgerloom.session import local_session  # noqa: E402
from ledgerloom.sources.delivery import MEAT_RECIPE, TOPPINGS, VEGETARIAN_RECIPE  # noqa: E402
from ledgerloom.sources.tables import inline_table  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(cores=8, shuffle_partitions=4, memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """table(name, rows) gives a job input from literal rows."""

    def make(name, rows):
        return inline_table(spark, name, rows)

    return make


def rows(df):
    return [tuple(r) for r in df.collect()]


def sorted_rows(df):
    return sorted(rows(df), key=repr)


def day(text):
    return date.fromisoformat(text)


def moment(text):
    return datetime.fromisoformat(text)


# The small restaurant and delivery tables.
SALES = [
    ("A", "2021-01-01", 1), ("A", "2021-01-01", 2), ("A", "2021-01-07", 2),
    ("A", "2021-01-10", 3), ("A", "2021-01-11", 3), ("A", "2021-01-11", 3),
    ("B", "2021-01-01", 2), ("B", "2021-01-02", 2), ("B", "2021-01-04", 1),
    ("B", "2021-01-11", 1), ("B", "2021-01-16", 3), ("B", "2021-02-01", 3),
    ("C", "2021-01-01", 3), ("C", "2021-01-01", 3), ("C", "2021-01-07", 3),
]
MENU = [(1, "sushi", 10), (2, "curry", 15), (3, "ramen", 12)]
MEMBERS = [("A", "2021-01-07"), ("B", "2021-01-09")]
RUNNERS = [(1, "2021-01-01"), (2, "2021-01-03"), (3, "2021-01-08"), (4, "2021-01-15")]
ORDERS = [
    (1, 101, 1, "", "", "2020-01-01 18:05:02"),
    (2, 101, 1, "", "", "2020-01-01 19:00:52"),
    (3, 102, 1, "", "", "2020-01-02 23:51:23"),
    (3, 102, 2, "", None, "2020-01-02 23:51:23"),
    (4, 103, 1, "4", "", "2020-01-04 13:23:46"),
    (4, 103, 1, "4", "", "2020-01-04 13:23:46"),
    (4, 103, 2, "4", "", "2020-01-04 13:23:46"),
    (5, 104, 1, "null", "1", "2020-01-08 21:00:29"),
    (6, 101, 2, "null", "null", "2020-01-08 21:03:13"),
    (7, 105, 2, "null", "1", "2020-01-08 21:20:29"),
    (8, 102, 1, "null", "null", "2020-01-09 23:54:33"),
    (9, 103, 1, "4", "1, 5", "2020-01-10 11:22:59"),
    (10, 104, 1, "null", "null", "2020-01-11 18:34:49"),
    (10, 104, 1, "2, 6", "1, 4", "2020-01-11 18:34:49"),
]
RUNS = [
    (1, 1, "2020-01-01 18:15:34", "20km", "32 minutes", ""),
    (2, 1, "2020-01-01 19:10:54", "20km", "27 minutes", ""),
    (3, 1, "2020-01-03 00:12:37", "13.4km", "20 mins", None),
    (4, 2, "2020-01-04 13:53:03", "23.4", "40", None),
    (5, 3, "2020-01-08 21:10:57", "10", "15", None),
    (6, 3, "null", "null", "null", "Restaurant Cancellation"),
    (7, 2, "2020-01-08 21:30:45", "25km", "25mins", "null"),
    (8, 2, "2020-01-10 00:15:02", "23.4 km", "15 minute", "null"),
    (9, 2, "null", "null", "null", "Customer Cancellation"),
    (10, 1, "2020-01-11 18:50:20", "10km", "10minutes", "null"),
]
CUSTOMER_IDS = {"A": 1, "B": 2, "C": 3}


@pytest.fixture(scope="session")
def restaurant(table):
    from decimal import Decimal

    return {
        "sales": table("sales", [(CUSTOMER_IDS[c], day(d), p) for c, d, p in SALES]),
        "menu": table("menu", [(i, n, Decimal(p)) for i, n, p in MENU]),
        "members": table("members", [(CUSTOMER_IDS[c], day(d)) for c, d in MEMBERS]),
    }


@pytest.fixture(scope="session")
def kitchen(table):
    return {
        "customer_orders": table("customer_orders", [(*o[:5], moment(o[5])) for o in ORDERS]),
        "runner_orders": table("runner_orders", RUNS),
        "runners": table("runners", [(r, day(d)) for r, d in RUNNERS]),
        "pizza_names": table("pizza_names", [(1, "Meatlovers"), (2, "Vegetarian")]),
        "pizza_recipes": table("pizza_recipes", [(1, MEAT_RECIPE), (2, VEGETARIAN_RECIPE)]),
        "pizza_toppings": table("pizza_toppings", TOPPINGS),
    }
