"""Operators against brute force on small random frames, and their edge cases."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from conftest import moment, rows, sorted_rows
from pyspark.sql import functions as F

from ledgerloom import session
from ledgerloom.functions.dates import minute_part
from ledgerloom.functions.text import clean_token, list_size, unit_number
from ledgerloom.operators import positions
from ledgerloom.operators.lists import render_list, tokenize_list
from ledgerloom.operators.topn import leaders, not_in, top_n, top_n_with_ties
from ledgerloom.sources.sinks import append_table, save_table


@pytest.mark.parametrize("copies", [1, 3, 100_000])
def test_row_numbers_with_a_hot_key(spark, monkeypatch, copies):
    monkeypatch.setattr(positions, "COPIES_PER_TASK", copies)
    draw = random.Random(copies)
    data = [(0 if draw.random() < 0.5 else draw.randrange(20), draw.randrange(40)) for _ in range(600)]
    df = spark.createDataFrame(data, "k int, v int")
    block = {"_block": F.floor(F.col("v") / 4)}
    numbered = sorted(rows(positions.number_rows(df, ["k"], block, ["v"], "n")))
    for key in set(k for k, _ in data):
        found = sorted((n, v) for k, v, n in numbered if k == key)
        values = sorted(v for k, v in data if k == key)
        assert found == list(enumerate(values, start=1))


def test_ranks_share_ties(spark):
    draw = random.Random(5)
    data = [(draw.randrange(3), draw.randrange(30)) for _ in range(400)]
    df = spark.createDataFrame(data, "k int, v int")
    ranked = positions.rank_values(df, ["k"], "v", 7)
    expected = {
        (k, v): 1 + sum(1 for a, b in data if a == k and b > v) for k, v in set(data)
    }
    assert {(r["k"], r["v"]): r["rn"] for r in ranked.collect()} == expected


def test_top_n_cuts_ties_and_places_null_last(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, None), (4, 1)], "k int, v int")
    assert rows(top_n(df, "v", 1, ["k"])) == [(1, 5)]
    assert rows(top_n(df, "v", 1, ["k"], ascending=True)) == [(3, None)]


def test_top_n_with_ties(spark):
    df = spark.createDataFrame([(k, v) for k, v in enumerate([9, 9, 8, 7, 7, 7, 1])], "k int, v int")
    kept = top_n_with_ties(df, "v", 4).collect()
    assert Counter((r["v"], r["rn"]) for r in kept) == {(9, 1): 2, (8, 3): 1, (7, 4): 3}


def test_leaders_keep_ties(spark):
    df = spark.createDataFrame([(1, "a", 2), (1, "b", 2), (1, "c", 1), (2, "a", 1)], "k int, i string, n int")
    assert sorted_rows(leaders(df, ["k"], "n").select("k", "i")) == [(1, "a"), (1, "b"), (2, "a")]


def test_not_in_is_null_aware(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    some = spark.createDataFrame([(1,)], "x int")
    null = spark.createDataFrame([(1,), (None,)], "x int")
    empty = spark.createDataFrame([], "x int")
    assert rows(not_in(left, "k", some, "x")) == [(2,)]
    assert rows(not_in(left, "k", null, "x")) == []
    assert len(rows(not_in(left, "k", empty, "x"))) == 3


def test_minute_part_is_a_component(spark):
    pairs = [("2020-01-01 10:00:00", "2020-01-01 12:07:59"), ("2020-01-01 10:00:00", "2020-01-01 10:00:59")]
    df = spark.createDataFrame([(moment(a), moment(b)) for a, b in pairs], "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(minute_part(F.col("a"), F.col("b"))).collect()] == [7, 0]


def test_text_cleaning(spark):
    texts = ["", "null", "NaN", None, "4", "1, 5", "23.4 km", "25mins", "40"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    c = F.col("t")
    assert [r[0] for r in df.select(clean_token(c)).collect()] == [None] * 4 + texts[4:]
    assert [r[0] for r in df.select(list_size(c)).collect()][:6] == [0, 0, 0, 0, 1, 2]
    numbers = [r[0] for r in df.select(unit_number(c, "decimal(10,2)")).collect()]
    assert [None if n is None else float(n) for n in numbers] == [None] * 4 + [4, 1, 23.4, 25, 40]


def test_lists_go_to_rows_and_back(spark):
    df = spark.createDataFrame([(1, "b, a"), (2, ""), (3, None), (4, "c,,d")], "k int, t string")
    parts = tokenize_list(df, "t", "part")
    assert sorted_rows(parts.select("k", "part")) == [(1, "a"), (1, "b"), (4, ""), (4, "c"), (4, "d")]
    plain = render_list(parts, ["k"], ["part"], "part", "text")
    blocks = render_list(
        parts.withColumn("b", F.substring("part", 1, 1)), ["k"], ["part"], "part", "text", block="b"
    )
    assert sorted_rows(plain) == sorted_rows(blocks) == [(1, "a, b"), (4, ", c, d")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2020, 1), (2021, 2)], "calendar_year int, v int")
    path = save_table(df, str(tmp_path / "t"), ["calendar_year"])
    save_table(df, path, ["calendar_year"])  # idempotent
    stored = spark.read.parquet(path)
    assert sorted_rows(stored.select("calendar_year", "v")) == [(2020, 1), (2021, 2)]
    assert stored.filter("calendar_year = 2020").inputFiles()
    ratings = save_table(df, str(tmp_path / "r"))
    append_table(spark.createDataFrame([(2022, 3)], "a int, b int"), ratings, ["calendar_year", "v"])
    assert spark.read.parquet(ratings).count() == 3


def test_numbering_asks_for_small_partitions(spark):
    """A task that sorts and hashes 64 MB of compressed rows needs more than 1 GB; a size that was set stays."""
    lines = spark.range(6).selectExpr("id % 2 AS k", "id AS v")
    before = spark.conf.getAll.get(session.ADVISORY)
    try:
        for own, wanted in ((None, session.PARTITION_BYTES), ("32m", "32m")):
            spark.conf.unset(session.ADVISORY) if own is None else spark.conf.set(session.ADVISORY, own)
            numbered = positions.number_rows(lines, ["k"], {"_b": F.lit(0)}, ["v"])
            assert spark.conf.get(session.ADVISORY) == wanted
            assert sorted(tuple(r) for r in numbered.collect()) == [
                (0, 0, 1), (0, 2, 2), (0, 4, 3), (1, 1, 1), (1, 3, 2), (1, 5, 3)
            ]
    finally:
        spark.conf.unset(session.ADVISORY) if before is None else spark.conf.set(session.ADVISORY, before)
