"""How often a job reads a large table, seen in the plan that ran, with nothing small enough to broadcast."""

from __future__ import annotations

import re

import pytest
from test_skew import settings

import __spark_entry__ as entry_points
from ledgerloom.registry import QUERIES

NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}
ONE_LINEITEM = [
    "i01_month_year_to_date", "i04_drop_null_months", "i07_joined_interest", "i08_month_before_created",
    "i12_interests_per_month", "i13_filtered_metrics", "i16_worst_ranking5", "i17_most_variable5",
    "i18_percentile_extremes", "i18_percentile_extremes_per_interest",
    "r07_items_before_join_last_only", "d33_delivery_fact", "d26_ingredient_list", "r12_member_order_rank",
]
TWO_EVENTS = [
    "c22_users_in_all_campaigns", "c23_impressed_vs_not", "c24_click_purchase_rate", "c25_campaign_uplift",
]


def scans(spark, key, column):
    """Scans in the final plan that read the column."""
    with settings(spark, NO_BROADCAST):
        df = QUERIES[key](spark, entry_points.SMOKE_FOLDER)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    return len(re.findall(rf"Scan parquet *\[[^\]]*\b{column}", final))


@pytest.mark.parametrize("key", ONE_LINEITEM)
def test_lineitem_is_read_once(spark, key):
    assert scans(spark, key, "l_") == 1


@pytest.mark.parametrize("key", TWO_EVENTS)
def test_events_are_read_for_facts_and_users_only(spark, key):
    assert scans(spark, key, "event_id") <= 2
