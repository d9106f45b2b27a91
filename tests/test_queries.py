"""Every registered query against SQL on the same tables, and the shape of its plan."""

from __future__ import annotations

import re

import pytest
from compare import difference, sql_connection

import __spark_entry__ as entry_points
from ledgerloom.oracle.all import SQL
from ledgerloom.registry import QUERIES

FOLDER = entry_points.SMOKE_FOLDER
# The optional training-data queries have tests of their own.
KEYS = sorted(QUERIES)
# Windows without a partition: one row per month or other small group, or ten rows.
SMALL_WINDOWS = re.compile(r"^(s14|s15|s16|i10|i14|i15|i18|i22|w09)")


@pytest.fixture(scope="module")
def sql():
    return sql_connection(FOLDER)


def test_every_query_has_sql():
    assert set(KEYS) == set(SQL)
    assert set(KEYS) <= set(entry_points.queries())


@pytest.mark.parametrize("key", KEYS)
def test_matches_sql(spark, sql, key):
    result = entry_points.queries()[key](spark, FOLDER).toArrow()
    expected = sql.execute(entry_points.oracle_sql()[key]).to_arrow_table()
    assert difference(result, expected) is None


@pytest.mark.parametrize("key", KEYS)
def test_plan_shape(spark, key):
    df = entry_points.queries()[key](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "EvalPython" not in plan and "InPandas" not in plan and "MapInArrow" not in plan
    one_task_window = re.search(r"- Window .*\n(.*- Sort .*\n)?.*Exchange SinglePartition", plan)
    assert not one_task_window or SMALL_WINDOWS.match(key), one_task_window
    if key.startswith("i22"):
        assert one_task_window  # the pattern does find such windows


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
