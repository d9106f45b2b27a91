"""Intervals of any length, ordered work on hot keys, roll-ups: against plain Python, and the shape of their plans."""

from __future__ import annotations

import random
import re
from collections import Counter
from datetime import datetime, timedelta
from statistics import median

import pytest
from conftest import day, rows, sorted_rows
from pyspark.sql import Window
from pyspark.sql import functions as F
from test_scans import NO_BROADCAST
from test_skew import settings

from ledgerloom.operators import intervals, ordered, rollup
from ledgerloom.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
NOON = datetime(2024, 1, 1, 12)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


# Intervals


@pytest.fixture(scope="module")
def calendar():
    draw = random.Random(1)
    times = [NOON + timedelta(microseconds=draw.randrange(10 ** draw.randrange(1, 15))) for _ in range(400)]
    times += [datetime(1969, 12, 31, 23, 59, 59, 999_999), datetime(1970, 1, 1), NOON, NOON, None]
    spans = [(i, NOON + timedelta(microseconds=draw.randrange(10**13)), draw.randrange(10 ** draw.randrange(1, 15))) for i in range(120)]
    spans = [(i, a, a + timedelta(microseconds=n)) for i, a, n in spans]
    spans += [(200, datetime(1960, 1, 1), datetime(1980, 1, 1)), (201, NOON, NOON), (202, NOON, NOON - timedelta(1)), (203, None, NOON), (204, datetime(1950, 1, 1), datetime(2100, 1, 1))]
    return list(enumerate(times)), spans


def test_intervals_of_any_length(spark, calendar):
    times, spans = calendar
    events = spark.createDataFrame(times, "event long, t timestamp_ntz")
    table = spark.createDataFrame(spans, "name long, a timestamp_ntz, b timestamp_ntz")
    found = rows(intervals.interval_join(events, table, "t", "a", "b").select("event", "name"))
    want = [(e, n) for e, t in times for n, a, b in spans if t and a and b and a <= t <= b]
    assert Counter(found) == Counter(want) and len(want) > 500
    sums = intervals.interval_totals(events, table, "t", "a", "b", {"n": F.lit(1).cast("long"), "e": F.col("event")})
    of = {n: [e for e, m in want if m == n] for n, _, _ in spans}
    assert sorted_rows(sums) == sorted([(n, a, b, len(of[n]), sum(of[n])) for n, a, b in spans], key=repr)


def test_crowded_cells_are_cut_into_tiles(spark, monkeypatch):
    """One cell that all rows and intervals share is joined in tiles, each pair in one of them."""
    monkeypatch.setattr(intervals, "TILE", 16)
    at = spark.range(1000).selectExpr("id AS event", "struct(1 AS level, 7L AS cell) AS _cell")
    at = at.union(spark.createDataFrame([(-1, (1, 8))], at.schema))
    laid = spark.range(100).selectExpr("id AS name", "struct(1 AS level, 7L AS cell) AS _cell")
    laid = laid.union(spark.createDataFrame([(-1, (1, 8))], laid.schema))
    left, right = intervals.tiled(at, laid, ["_cell"], (["event"], ["name"]))
    tile = ["_cell", "_at_part", "_laid_part"]
    for side in (left, right):
        sizes = [r["count"] for r in side.groupBy(*tile).count().collect()]
        assert len(sizes) > 300 and max(sizes) < 64
        assert side.select("_at_part").distinct().count() == 63 and side.select("_laid_part").distinct().count() == 7
    pairs = rows(left.join(right, tile).select("event", "name"))
    assert Counter(pairs) == Counter([(e, n) for e in range(1000) for n in range(100)] + [(-1, -1)])


def test_pairs_of_one_span_are_made_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(intervals, "TILE", 32)
    rows_ = spark.range(4000).selectExpr("id AS event", "TIMESTAMP_NTZ'2024-01-01 12:00:00' + make_dt_interval(0, 0, 0, id) AS t")
    table = spark.range(40).selectExpr(
        "id AS name", "TIMESTAMP_NTZ'2023-01-01 00:00:00' AS a", "TIMESTAMP_NTZ'2025-01-01 00:00:00' AS b"
    )
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(merge)
    spark.conf.set(merge, "false")
    try:
        found = intervals.interval_join(rows_, table, "t", "a", "b")
        by_task = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set(merge, before)
    assert sum(by_task) == 160_000 and max(by_task) < 80_000


def sent(plan):
    """Rows that the exchanges of a plan that has run have written."""
    name, own = plan.nodeName(), plan.metrics()
    if name.startswith(("AdaptiveSparkPlan", "ShuffleQueryStage", "BroadcastQueryStage", "ResultQueryStage")):
        below = [plan.executedPlan() if name.startswith("Adaptive") else plan.plan()]
    else:
        below = [plan.children().apply(i) for i in range(plan.children().size())]
    return (own.apply("shuffleRecordsWritten").value() if name == "Exchange" else 0) + sum(map(sent, below))


def test_rows_and_intervals_travel_few_times(spark):
    """A row goes to one block, an interval to those it touches; neither is sent once for each level or pair."""
    n, m = 20_000, 300
    times = spark.range(n).selectExpr("id AS event", "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 97.123457) AS t")
    table = spark.range(m).selectExpr("id AS name", "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 613) AS a")
    table = table.selectExpr("*", "a + make_dt_interval(0, 0, 0, CAST(pow(2, name % 24) AS DECIMAL(18, 6))) AS b")
    found = intervals.interval_join(times, table, "t", "a", "b")
    pairs = len(found.collect())
    assert pairs > 600_000
    # Besides, each side is counted by block, and the intervals are spread over tasks, both twice.
    assert sent(found._jdf.queryExecution().executedPlan()) < n + 257 * m + 30_000 < pairs // 4


def test_blocks_pages_and_chunks_cut_anywhere(spark, monkeypatch):
    """Half of the rows share one time, few times in all, long and short intervals that begin and end at rows."""
    draw = random.Random(9)
    at = [(i, NOON + timedelta(seconds=0 if i % 2 else draw.randrange(-40, 40)), i % 5) for i in range(600)]
    spans = [(i, NOON + timedelta(seconds=draw.randrange(-50, 50)), timedelta(seconds=draw.choice([0, 0, 1, 2, 7, 60]))) for i in range(150)]
    spans = [(i, a, a + n, "x" * (i % 3)) for i, a, n in spans] + [(-1, NOON - timedelta(9999), NOON + timedelta(9999), None)]
    events = spark.createDataFrame(at, "event long, t timestamp_ntz, other long")
    table = spark.createDataFrame(spans, "name long, a timestamp_ntz, b timestamp_ntz, note string")
    want = Counter((e, x, note) for e, t, x in at for _, a, b, note in spans if a <= t <= b)
    for tile, page, chunk in ((8, 4, 4), (8, 1, 3), (1 << 15, 1 << 6, 1 << 8)):
        for name, value in (("TILE", tile), ("PAGE", page), ("CHUNK", chunk)):
            monkeypatch.setattr(intervals, name, value)
        found = intervals.interval_join(events, table, "t", "a", "b", columns=["event", "other", "note"])
        assert found.columns == ["event", "other", "note"] and Counter(rows(found)) == want
    every = intervals.interval_join(events, table, "t", "a", "b")
    assert every.columns == ["event", "t", "other", "name", "a", "b", "note"] and every.count() == sum(want.values())
    assert rows(intervals.interval_join(events.limit(0), table, "t", "a", "b")) == []


def test_intervals_with_a_key(spark, calendar):
    times, spans = calendar
    events = spark.createDataFrame([(e, t, e % 3) for e, t in times], "event long, t timestamp_ntz, k long")
    table = spark.createDataFrame([(*s, s[0] % 3) for s in spans], "name long, a timestamp_ntz, b timestamp_ntz, k long")
    found = rows(intervals.interval_join(events, table, "t", "a", "b", ["k"]).select("event", "name"))
    want = [(e, n) for e, t in times for n, a, b in spans if t and a and b and a <= t <= b and e % 3 == n % 3]
    assert sorted(found) == sorted(want)
    assert rows(intervals.interval_join(events, table.limit(0), "t", "a", "b", ["k"])) == []


def test_cells_grow_with_the_logarithm(spark):
    """A thousand times the length is at most 2.5 levels of 30 cells more; a second and ten years both fit in 500."""
    spans = [(NOON, NOON + timedelta(microseconds=10**k - 1 + k * 7)) for k in range(0, 15)]
    spans += [(NOON, NOON + timedelta(days=3653)), (NOON, NOON + timedelta(seconds=1))]
    table = spark.createDataFrame(spans, "a timestamp_ntz, b timestamp_ntz")
    cells = table.select(F.size(intervals.cover(intervals.ticks(F.col("a")), intervals.ticks(F.col("b")))))
    counts = [r[0] for r in cells.collect()]
    assert max(counts[:15]) <= 30 * 13 and max(counts) < 500
    assert all(b <= a + 75 for a, b in zip(counts[:12], counts[3:15]))


def test_cover_is_exact(spark):
    pairs = [(a, b) for a in range(-70, 300, 37) for b in range(a, a + 600, 53)]
    table = spark.createDataFrame(pairs, "a long, b long")
    for a, b, cells in table.select("a", "b", intervals.cover(F.col("a"), F.col("b"))).collect():
        points = Counter(x for c in cells for x in range(c["cell"] << 4 * c["level"], c["cell"] + 1 << 4 * c["level"]))
        assert points == Counter(range(a, b + 1))


# Ordered work


@pytest.fixture(scope="module")
def log(spark):
    """Half of the rows belong to key 7, many rows share a time."""
    draw = random.Random(5)
    data = [
        (7 if draw.random() < 0.5 else draw.randrange(20), NOON + timedelta(hours=draw.randrange(900)), i, draw.choice("vvvcccpx"))
        for i in range(6000)
    ]
    return data, spark.createDataFrame(data, "k long, t timestamp_ntz, i long, kind string").repartition(8)


def by_day(time):
    return F.date_trunc("DD", time)


def test_as_of_a_hot_key(spark, log):
    data, events = log
    draw = random.Random(6)
    states = [(draw.randrange(0, 25, 2), NOON + timedelta(hours=draw.randrange(900)), draw.randrange(5)) for _ in range(150)]
    states += [(7, NOON + timedelta(hours=h), h % 5) for h in range(3, 900, 90)] + [(7, NOON + timedelta(hours=3), 4)]
    table = spark.createDataFrame(states, "k long, since timestamp_ntz, plan int")
    found = ordered.as_of(events, table, ["k"], "t", "since", ["plan"], by_day)
    want = []
    for k, t, i, kind in data:
        own = [(s, p) for key, s, p in states if key == k and s <= t]
        want.append((k, t, i, kind, max(own)[1] if own else None))
    assert sorted_rows(found) == sorted(want, key=repr)


def test_a_hot_key_is_cut_into_blocks(spark, log):
    """No window holds a key as a whole: rows meet by key and block, and only block ends by key."""
    _, events = log
    with settings(spark, NO_BROADCAST):
        plan = final_plan(ordered.carry_last(events, ["k"], by_day(F.col("t")), ["t", "i"], "kind", "last"))
        paged = final_plan(framed_lags(events, 3, 50))
    windows = re.findall(r"- Window .*", plan)
    # the window by key alone runs over one row a block
    assert windows and all("_leaf" in w or "_carried" in w for w in windows)
    # so do the windows that add up the sizes of blocks
    windows = re.findall(r"- Window .*", paged)
    assert windows and all("_leaf" in w or "_page" in w or "_size" in w or "_skip" in w for w in windows)
    leaves = events.groupBy("k", by_day(F.col("t"))).count().agg(F.max("count")).first()[0]
    assert leaves < 6000 / 20


def framed_lags(events, n, page):
    def columns(window):
        return {
            "lag": F.lag("i", n).over(window), "lead": F.lead("i", n).over(window),
            "sum": F.sum("i").over(window.rowsBetween(1 - n, 0)), "first": F.first("i").over(window.rowsBetween(-n, -1)),
        }

    daily = events.withColumn("d", F.to_date("t"))
    return ordered.framed(daily, ["k"], ["d"], ["t", "i"], n, n, columns, page).drop("d")


@pytest.mark.parametrize("n", range(1, 11))
def test_frames_over_pages(spark, log, n):
    data, events = log
    window = Window.partitionBy("k").orderBy("t", "i")
    plain = events.select(
        "*", F.lag("i", n).over(window).alias("lag"), F.lead("i", n).over(window).alias("lead"),
        F.sum("i").over(window.rowsBetween(1 - n, 0)).alias("sum"), F.first("i").over(window.rowsBetween(-n, -1)).alias("first"),
    )
    assert sorted_rows(framed_lags(events, n, 10 + n)) == sorted_rows(plain)
    assert sorted_rows(framed_lags(events, n, n)) == sorted_rows(plain)


def test_frames_need_long_pages(log):
    with pytest.raises(ValueError, match="page"):
        framed_lags(log[1], 5, 4)


def test_ranks_of_crowded_values(spark):
    """Nine of ten values lie in one unit, half of the rows have one value; blocks are even all the same."""
    draw = random.Random(7)
    values = [draw.random() if draw.random() < 0.9 else draw.uniform(0, 10**6) for _ in range(20_000)]
    data = [(i % 2, v) for i, v in enumerate(values)] + [(0, 0.5)] * 20_000 + [(0, None), (1, None), (None, 3.0)]
    table = spark.createDataFrame(data, "k int, v double")
    found = ordered.rank_even(table, ["k"], "v")
    window = Window.partitionBy("k").orderBy(F.desc_nulls_last("v"))
    plain = table.select("*", F.rank().over(window).alias("rn"), F.count(F.lit(1)).over(Window.partitionBy("k")).alias("rows"))
    assert Counter(rows(found)) == Counter(rows(plain))
    counted = table.where("v IS NOT NULL AND k IS NOT NULL").groupBy("k", "v").count()
    sizes = [r["count"] for r in ordered.sketch_blocks(counted, ["k"], "v").groupBy("k", "_block").count().collect()]
    assert max(sizes) <= 2 * median(sizes) and len(sizes) > 1000


def steps_reached(data, kinds, gap):
    """The steps that each key completes, by trying every earlier event."""
    out = Counter()
    for key in {k for k, *_ in data}:
        own = sorted((t, i, kind) for k, t, i, kind in data if k == key)
        done = [[] for _ in kinds]
        for t, _, kind in own:
            for j in range(len(kinds) - 1, -1, -1):
                if kind == kinds[j] and (j == 0 or any(gap is None or t <= s + gap for s in done[j - 1])):
                    done[j].append(t)
        out.update(j + 1 for j, times in enumerate(done) if times)
    return out


@pytest.mark.parametrize("kinds", ["vcp", "pcv", "vv", "xpxc", "z", "vzc"])
@pytest.mark.parametrize("hours", [None, 5, 40])
def test_ordered_funnel(spark, kinds, hours):
    draw = random.Random(len(kinds) * 100 + (hours or 0))
    data = [
        (7 if draw.random() < 0.3 else draw.randrange(60), NOON + timedelta(hours=draw.randrange(900)), i, draw.choice("vvcpx"))
        for i in range(500)
    ]
    events = spark.createDataFrame(data, "k long, t timestamp_ntz, i long, kind string")
    steps = {f"{j}{c}": F.col("kind") == c for j, c in enumerate(kinds)}
    gap = f"'{hours}' HOUR" if hours else None
    found = ordered.ordered_funnel(events, ["k"], "t", ["t", "i"], steps, gap, by_day)
    want = steps_reached(data, kinds, timedelta(hours=hours) if hours else None)
    assert sorted(rows(found)) == [(j, name, want[j]) for j, name in enumerate(steps, 1)]


def test_runs_of_a_hot_key(spark):
    draw = random.Random(9)
    data = [(7, p) for p in range(-300, 9000) if p % 97 and not 500 < p < 700] + [(7, 3)] * 50
    data += [(draw.randrange(30), draw.randrange(60)) for _ in range(600)] + [(None, 4), (None, 6)]
    table = spark.createDataFrame(data, "k long, p long")
    want = []
    for key in {k for k, _ in data}:
        own = sorted({p for k, p in data if k == key})
        starts = [p for p in own if p - 1 not in own] if len(own) < 1000 else [p for i, p in enumerate(own) if i == 0 or own[i - 1] != p - 1]
        for i, first in enumerate(starts):
            later = starts[i + 1] if i + 1 < len(starts) else None
            last = max(p for p in own if p < (later if later is not None else p + 1))
            want.append((key, first, last, last - first + 1, None if later is None else later - last - 1))
    for width in (64, 4096):
        assert sorted_rows(ordered.runs(table, ["k"], "p", width)) == sorted(want, key=repr)


# Roll-ups


def test_distinct_counts_from_stored_states(spark, tmp_path):
    """Days written one after the other give the counts of all rows; numbers of any size, nulls and repeats."""
    draw = random.Random(4)
    data = [(day("2021-01-01") + timedelta(draw.randrange(400)), draw.choice([0, 1, 32768, 32769, draw.randrange(10**6), 10**12, None])) for _ in range(3000)]
    path = str(tmp_path / "states")
    for part in (data[:1000], data[1000:]):
        states = rollup.distinct_states(spark.createDataFrame(part, "day date, id long"), "day", "id")
        states.write.mode("append").parquet(path)
    periods = {"month": F.trunc("day", "month"), "year": F.trunc("day", "year"), "all": F.lit(None).cast("date")}
    found = rollup.distinct_counts(spark.read.parquet(path), periods, "n")
    ids = {}
    for d, i in data:
        if i is not None:
            for kind, start in (("month", d.replace(day=1)), ("year", d.replace(day=1, month=1)), ("all", None)):
                ids.setdefault((kind, start), set()).add(i)
    assert sorted_rows(found) == sorted([(*k, len(v)) for k, v in ids.items()], key=repr)


def test_each_dimension_at_once(spark):
    data = [("a", None, 1), ("a", "x", 2), (None, "x", 4), ("b", None, 8), ("b", "b", 16)]
    table = spark.createDataFrame(data, "p string, q string, n int")
    found = rollup.by_each(table, ["p", "q"], [F.sum("n").alias("n")])
    assert sorted_rows(found) == sorted([
        (1, "p", "a", 3), (1, "p", None, 4), (1, "p", "b", 24), (2, "q", None, 9), (2, "q", "x", 6), (2, "q", "b", 16),
    ], key=repr)


@pytest.mark.parametrize(
    "key, column, scans",
    [
        ("a04_customers_by_period", "o_", 1), ("o09_impact_by_each", "l_", 1), ("o10_step_funnel", "event_id|user_id", 1),
        ("o14_order_month_runs", "o_", 1), ("n03_order_ranks", "o_", 2), ("o04_order_plan_as_of", "o_", 2),
    ],
)
def test_scans(spark, key, column, scans):
    with settings(spark, NO_BROADCAST):
        plan = final_plan(QUERIES[key](spark, FOLDER))
    assert len(re.findall(rf"Scan parquet *\[[^\]]*\b(?:{column})", plan)) == scans


def test_one_expand_for_all_dimensions(spark):
    with settings(spark, NO_BROADCAST):
        plan = final_plan(QUERIES["o09_impact_by_each"](spark, FOLDER))
    assert len(re.findall(r"[- ]Expand ", plan)) == 1


# Two tables


def test_changes_between_tables(spark):
    from ledgerloom.operators.reconcile import row_changes

    draw = random.Random(2)
    old = {i: (draw.choice([None, "x", "y"]), draw.choice([None, 1.5, 2.5])) for i in range(2000)}
    new = {i: v for i, v in old.items() if i % 301}
    new |= {i: ("z", None) for i in range(0, 2000, 407) if i in new} | {5000: (None, None), 17: (old[17][1] and "w", None)}
    schema = "k long, a string, b double"
    one, two = (spark.createDataFrame([(k, *v) for k, v in t.items()], schema) for t in (old, new))
    want = {(k, "removed") for k in old if k not in new} | {(k, "added") for k in new if k not in old}
    want |= {(k, "changed") for k in old if k in new and old[k] != new[k]}
    for buckets in (1, 64, 4096):
        assert sorted(rows(row_changes(one, two, ["k"], buckets))) == sorted(want)
    assert rows(row_changes(one, one, ["k"])) == []
    assert sorted(rows(row_changes(one.limit(0), two, ["k"]))) == sorted((k, "added") for k in new)
