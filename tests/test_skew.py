"""A key that holds a large part of all rows: same answers, and its partition is split."""

from __future__ import annotations

import random
from collections import Counter
from contextlib import contextmanager
from datetime import timedelta
from decimal import Decimal

import pytest
from conftest import day, rows

from ledgerloom.plans import loyalty

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextmanager
def settings(spark, values):
    old = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in old.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture(scope="module")
def shop(table):
    draw = random.Random(3)
    start = day("2021-01-01")
    sales = [
        (7 if draw.random() < 0.5 else draw.randrange(200), start + timedelta(draw.randrange(30)),
         draw.randrange(500))
        for _ in range(20_000)
    ]
    members = [(c, start + timedelta(c % 20)) for c in range(0, 200, 2)] + [(7, start + timedelta(9))]
    data = {
        "sales": sales,
        "menu": [(p, f"p{p % 450}", Decimal(p % 13)) for p in range(500)],
        "members": members,
    }
    return data, [table(name, data[name]) for name in ("sales", "menu", "members")]


def test_a_hot_customer_is_split(spark, shop):
    data, (sales, menu, members) = shop
    with settings(spark, SETTINGS):
        flagged = loyalty.member_flagged_orders(sales.repartition(8), menu, members)
        found = Counter((r[0], r[4]) for r in flagged.collect())
        plan = flagged._jdf.queryExecution().executedPlan().toString()
    joined = dict(data["members"])
    expected = Counter(
        (c, "Y" if c in joined and d >= joined[c] else "N") for c, d, _ in data["sales"]
    )
    assert found == expected
    assert "skew=true" in plan


def test_ranks_of_a_hot_customer(spark, shop):
    data, inputs = shop
    joined, price = dict(data["members"]), {p: (n, x) for p, n, x in data["menu"]}
    expected = []
    for customer in set(c for c, _, _ in data["sales"]):
        number = 0
        for d, p in sorted((d, p) for c, d, p in data["sales"] if c == customer):
            member = customer in joined and d >= joined[customer]
            number += member
            expected.append((customer, d, *price[p], "Y" if member else "N", number if member else None))
    ranked = rows(loyalty.member_order_rank(*inputs))
    assert sorted(ranked, key=repr) == sorted(expected, key=repr)


def test_favourites_of_a_hot_customer(spark, shop):
    data, (sales, menu, _) = shop
    names = {p: n for p, n, _ in data["menu"]}
    counts = Counter((c, p) for c, _, p in data["sales"])
    best = Counter()
    for (c, _), n in counts.items():
        best[c] = max(best[c], n)
    expected = sorted((c, names[p]) for (c, p), n in counts.items() if n == best[c])
    assert sorted(rows(loyalty.favourite_item(sales, menu))) == expected
