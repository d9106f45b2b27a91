"""SQL checks for the jobs of plans/across.py, each stated on its own terms."""

from __future__ import annotations

from . import subscriptions, weekly
from .sql import rounded, with_inputs

PROMOTIONS = """
    SELECT promotion_id, starts, starts + to_seconds(1 << CAST(promotion_id % 29 AS INTEGER)) AS ends
    FROM (SELECT s_suppkey AS promotion_id,
                 TIMESTAMP '2024-01-01' + to_seconds(s_suppkey * 7919 % 2592000) AS starts FROM supplier) s"""
STEPS = ("view", "click", "purchase")


def _funnel(gap: str | None) -> str:
    """Step by step: an event counts if one of the step before lies earlier, at most the gap ago."""
    parts = [f"step_1 AS (SELECT user_id, ts, event_id FROM events WHERE event_type = '{STEPS[0]}')"]
    for i, kind in enumerate(STEPS[1:], 2):
        late = f" AND e.ts <= p.ts + INTERVAL {gap}" if gap else ""
        parts.append(f"""step_{i} AS (
            SELECT DISTINCT e.user_id, e.ts, e.event_id FROM events e JOIN step_{i - 1} p
            ON e.user_id = p.user_id AND (e.ts, e.event_id) > (p.ts, p.event_id){late}
            WHERE e.event_type = '{kind}')""")
    ends = " UNION ALL ".join(
        f"SELECT {i} AS number, '{kind}' AS step, COUNT(DISTINCT user_id) AS reached FROM step_{i}"
        for i, kind in enumerate(STEPS, 1)
    )
    return f"WITH {', '.join(parts)} {ends}"


def _impacts() -> str:
    change = rounded("after - before", "before", 2, 100)
    n = len(weekly.DIMENSIONS)
    parts = [
        f"""SELECT CAST({2**n - 1 - 2 ** (n - 1 - i)} AS INTEGER) AS grouping_id, '{dim}' AS dim, {dim} AS area,
                   CAST(SUM(sales) FILTER (week_number BETWEEN 13 AND 24) AS BIGINT) AS before,
                   CAST(SUM(sales) FILTER (week_number BETWEEN 25 AND 36) AS BIGINT) AS after
            FROM clean GROUP BY {dim}"""
        for i, dim in enumerate(weekly.DIMENSIONS)
    ]
    return f"SELECT *, {change} AS percentage FROM ({' UNION ALL '.join(parts)}) x"


# A month starts a run when the month before it is absent, and ends one when the month after it is.
RUNS = """
    months AS (
        SELECT DISTINCT o_custkey AS customer_id, CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS BIGINT) AS m
        FROM orders),
    firsts AS (SELECT * FROM months WHERE (customer_id, m - 1) NOT IN (SELECT customer_id, m FROM months)),
    lasts AS (SELECT * FROM months WHERE (customer_id, m + 1) NOT IN (SELECT customer_id, m FROM months)),
    spans AS (
        SELECT f.customer_id, f.m AS first, MIN(l.m) AS last FROM firsts f
        JOIN lasts l ON l.customer_id = f.customer_id AND l.m >= f.m GROUP BY f.customer_id, f.m),
    runs AS (
        SELECT s.customer_id, s.first, s.last, s.last - s.first + 1 AS n_periods,
               (SELECT MIN(f.m) FROM firsts f WHERE f.customer_id = s.customer_id AND f.m > s.last) - s.last - 1 AS missing
        FROM spans s)"""

SQL = {
    "j08_promotion_totals": f"""
        WITH promotions AS ({PROMOTIONS})
        SELECT promotion_id, starts, ends, COUNT(ts) AS n_events,
               COUNT(*) FILTER (event_type = 'purchase') AS n_purchases,
               CAST(coalesce(SUM(CAST(round(value * 100) AS BIGINT)) FILTER (event_type = 'purchase'), 0) AS BIGINT) AS cents
        FROM promotions LEFT JOIN events ON ts >= starts AND ts <= ends GROUP BY promotion_id, starts, ends""",
    "j08_purchases_in_promotions": f"""
        WITH promotions AS ({PROMOTIONS})
        SELECT event_id, user_id, promotion_id FROM events, promotions
        WHERE event_type = 'purchase' AND ts BETWEEN starts AND ends""",
    "o04_order_plan_as_of": with_inputs(
        {"subscriptions": subscriptions.INPUTS["subscriptions"]},
        """
        SELECT o_orderkey, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
               CAST(right(MAX(strftime(start_date, '%Y-%m-%d') || plan_id), 1) AS INTEGER) AS plan_id
        FROM orders LEFT JOIN subscriptions s ON s.customer_id = o_custkey AND start_date <= CAST(o_orderdate AS DATE)
        GROUP BY ALL""",
    ),
    "n06_order_neighbours": """
        SELECT o_orderpriority, o_orderkey, lag(o_orderkey) OVER w AS previous, lag(o_orderkey, 3) OVER w AS third_before,
               lead(o_orderkey) OVER w AS next,
               CAST(SUM(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT)
                   AS cents_of_7
        FROM orders WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey)""",
    "n03_order_ranks": """
        WITH units AS (
            SELECT o_orderkey, o_orderstatus, CAST(floor(o_totalprice / 1000) AS BIGINT) AS thousands FROM orders)
        SELECT *, rank() OVER (PARTITION BY o_orderstatus ORDER BY thousands DESC) AS rn,
               COUNT(*) OVER (PARTITION BY o_orderstatus) AS "rows"
        FROM units""",
    "o10_step_funnel": _funnel(None),
    "o10_step_funnel_half_day": _funnel("'12 hours'"),
    "a04_customers_by_period": " UNION ALL ".join(
        f"""SELECT '{kind}' AS kind, CAST(date_trunc('{kind}', o_orderdate) AS DATE) AS start,
                   COUNT(DISTINCT o_custkey) AS customers FROM orders GROUP BY ALL"""
        for kind in ("month", "quarter", "year")
    ),
    "o09_impact_by_each": with_inputs(weekly.INPUTS, _impacts()),
    "o13_order_changes": """
        SELECT o_orderkey, 'removed' AS change FROM orders WHERE o_orderkey % 97 = 5
        UNION ALL SELECT -o_orderkey - 1, 'added' FROM orders WHERE o_orderkey % 89 = 4
        UNION ALL SELECT o_orderkey, 'changed' FROM orders
            WHERE o_orderkey % 97 <> 5 AND o_custkey % 11 = 3 AND o_orderstatus = 'O'""",
    "o14_order_month_runs": f"WITH {RUNS} SELECT * FROM runs",
    "o14_order_month_summary": f"""
        WITH {RUNS}
        SELECT customer_id, COUNT(*) AS n_runs, MAX(n_periods) AS longest_run, MAX(missing) AS longest_gap,
               CAST(SUM(missing) AS BIGINT) AS missing_months
        FROM runs GROUP BY customer_id""",
}
