"""Subscriptions: plan mix, churn, upgrades, payments and growth.

Inputs: subscriptions(customer_id, plan_id, start_date) with at most one row per
customer and plan, plans(plan_id, plan_name, price). A customer's window therefore
holds no more rows than there are plans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import percent, ratio, truncated_avg
from ..operators.compare import histogram, period_ratio
from ..operators.state import billing_schedule, next_state, state_at

TRIAL, BASIC, PRO, ANNUAL, CHURN = range(5)


def _date(text: str) -> Column:
    return F.lit(text).cast("date")


def _customers(subscriptions: DataFrame) -> Column:
    return subscriptions.agg(F.count_distinct("customer_id").alias("n")).scalar()


def _known(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    """Subscriptions whose plan is in the plan table."""
    return subscriptions.join(plans.select("plan_id"), "plan_id", "left_semi")


def _with_next(subscriptions: DataFrame, plans: DataFrame, order: str = "plan_id") -> DataFrame:
    """Add plan_n, the customer's next plan; as written the order is the plan number."""
    by = [order] if order == "plan_id" else [order, "plan_id"]
    return next_state(_known(subscriptions, plans), "customer_id", by, "plan_id", "plan_n")


def customer_journey(
    subscriptions: DataFrame, plans: DataFrame, below: int | None = None
) -> DataFrame:
    """Each customer's plans with price; `below` keeps the customers under an id."""
    if below is not None:
        subscriptions = subscriptions.filter(F.col("customer_id") < below)
    return subscriptions.join(plans, "plan_id").select(
        "customer_id", "plan_id", "plan_name", "price", "start_date"
    )


def total_customers(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.agg(F.count_distinct("customer_id").alias("Total_customers"))


def trials_by_month(subscriptions: DataFrame) -> DataFrame:
    trials = subscriptions.filter(F.col("plan_id") == TRIAL)
    month = F.month("start_date").alias("month")
    return trials.groupBy(month).agg(F.count(F.lit(1)).alias("trial_plan")).orderBy("month")


def events_before_after_cutoff(
    subscriptions: DataFrame, plans: DataFrame, cutoff: str
) -> DataFrame:
    """Starts per plan before and from the cutoff; plans with no start before are left out."""
    before = F.col("start_date") < _date(cutoff)
    counts = (
        subscriptions.join(plans, "plan_id", "left")
        .groupBy("plan_id", "plan_name")
        .agg(
            F.count_if(before).alias("events_2020"),
            F.count_if(~before).alias("events_2021"),
        )
    )
    return counts.filter(F.col("events_2020") > 0).orderBy("plan_id")


def churn_pct(subscriptions: DataFrame) -> DataFrame:
    churned = F.count_if(F.col("plan_id") == CHURN)
    return subscriptions.agg(
        churned.alias("churn_count"),
        percent(churned, F.count_distinct("customer_id"), 1).alias("churn_p"),
    )


def churn_after_trial(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    """Customers whose second plan by date is churn."""
    window = Window.partitionBy("customer_id").orderBy("start_date", "plan_id")
    numbered = _known(subscriptions, plans).withColumn("row", F.row_number().over(window))
    churned = F.count_if((F.col("plan_id") == CHURN) & (F.col("row") == 2)).alias("churn_count")
    return numbered.agg(churned).select(
        "churn_count", percent(F.col("churn_count"), _customers(subscriptions), 0).alias("churn_p")
    )


def next_plan_after_trial(
    subscriptions: DataFrame, plans: DataFrame, order: str = "plan_id"
) -> DataFrame:
    trials = _with_next(subscriptions, plans, order).filter(F.col("plan_id") == TRIAL)
    counts = trials.groupBy("plan_n").agg(F.count(F.lit(1)).alias("churn_count"))
    share = percent(F.col("churn_count"), _customers(subscriptions), 1)
    return counts.withColumn("churn_p", share).orderBy("plan_n")


def plan_mix_at_date(subscriptions: DataFrame, as_of: str, as_written: bool = True) -> DataFrame:
    held = state_at(subscriptions, "customer_id", "start_date", "plan_id", _date(as_of), as_written)
    counts = held.groupBy("plan_id").agg(F.count(F.lit(1)).alias("n_cut"))
    share = percent(F.col("n_cut"), _customers(subscriptions), 1)
    return counts.withColumn("n_cut_p", share).orderBy("plan_id")


def annual_upgrades(
    subscriptions: DataFrame, plans: DataFrame, year: int, order: str = "plan_id"
) -> DataFrame:
    moves = _with_next(subscriptions, plans, order)
    upgraded = (F.year("start_date") == year) & (F.col("plan_n") == ANNUAL)
    return moves.filter(upgraded).agg(F.count(F.lit(1)).alias("pro_annual_customer"))


def _days_to_annual(subscriptions: DataFrame) -> DataFrame:
    """Days from the trial to the annual start of each customer that has both.

    By contract a customer starts a plan once, so one aggregate takes the place of a self-join;
    of repeated starts the earliest counts, where a self-join would pair them all.
    """

    def start(plan: int) -> Column:
        return F.min(F.when(F.col("plan_id") == plan, F.col("start_date")))

    days = F.datediff(start(ANNUAL), start(TRIAL)).alias("d")
    known = subscriptions.filter(F.col("customer_id").isNotNull())
    both = known.groupBy("customer_id").agg(days)
    return both.filter(F.col("d").isNotNull()).select("d")


def avg_days_to_annual(subscriptions: DataFrame) -> DataFrame:
    average = truncated_avg(F.col("d")).alias("avg_days_for_annual_plan")
    return _days_to_annual(subscriptions).agg(average)


def days_to_annual_histogram(subscriptions: DataFrame, width: int = 30) -> DataFrame:
    return histogram(_days_to_annual(subscriptions), "d", width)


def downgrades(
    subscriptions: DataFrame, plans: DataFrame, year: int, order: str = "plan_id"
) -> DataFrame:
    """Moves from pro to basic monthly; by plan number there can be none, by date there can."""
    moves = _with_next(subscriptions, plans, order)
    down = (F.year("start_date") == year) & (F.col("plan_id") == PRO) & (F.col("plan_n") == BASIC)
    return moves.filter(down).agg(F.count(F.lit(1)).alias("down_customer"))


def payment_schedule(subscriptions: DataFrame, plans: DataFrame, year: int) -> DataFrame:
    """Payments of a year: monthly until the next plan or the year's end, annual plans once."""
    year_end = _date(f"{year}-12-31")
    dated = next_state(
        subscriptions, "customer_id", ["start_date", "plan_id"], "start_date", "next_date"
    ).join(plans, "plan_id", "left")
    paid = dated.filter(~F.col("plan_name").isin("trial", "churn"))
    # All payments of one customer and plan count from the first start of that plan.
    anchor = F.min("start_date").over(Window.partitionBy("customer_id", "plan_id"))
    periods = paid.withColumns({
        "anchor": anchor,
        "end": F.least(F.coalesce("next_date", year_end), year_end),
    }).filter(F.year("anchor") <= year)
    payments = billing_schedule(
        periods,
        ["customer_id", "plan_id", "plan_name", "price"],
        F.col("anchor"),
        F.col("end"),
        F.col("plan_id") != ANNUAL,
    ).filter(F.year("payment_date") == year)
    order = Window.partitionBy("customer_id").orderBy("plan_id", "payment_date")
    return payments.select(
        "customer_id", "plan_id", "plan_name", "payment_date",
        F.col("price").alias("amount"),
        F.rank().over(order).alias("payment_order"),
    ).orderBy("customer_id", "plan_id", "payment_date")


# Growth by month


def _by_month(df: DataFrame, year: int, name: str) -> DataFrame:
    starts = df.filter(F.year("start_date") == year)
    return starts.groupBy(F.month("start_date").alias("Month")).agg(F.count(F.lit(1)).alias(name))


def pro_plan_month_ratio(subscriptions: DataFrame, plans: DataFrame, year: int) -> DataFrame:
    pro = _known(subscriptions, plans).filter(F.col("plan_id").isin(PRO, ANNUAL))
    return period_ratio(_by_month(pro, year, "n"), "Month", "n", "pro_plan_percent")


def upgrade_month_ratio(
    subscriptions: DataFrame, plans: DataFrame, year: int, order: str = "plan_id"
) -> DataFrame:
    plan, after = F.col("plan_id"), F.col("plan_n")
    moves = _with_next(subscriptions, plans, order)
    upgrades = moves.filter((after != CHURN) & (plan != TRIAL) & (plan < after))
    return period_ratio(_by_month(upgrades, year, "n"), "Month", "n", "upgrade_percent")


def growth_joined(subscriptions: DataFrame, plans: DataFrame, year: int) -> DataFrame:
    upgrades = upgrade_month_ratio(subscriptions, plans, year)
    pro = pro_plan_month_ratio(subscriptions, plans, year)
    return upgrades.join(pro, "Month").select("Month", "pro_plan_percent", "upgrade_percent")


def new_customers_by_month(subscriptions: DataFrame, plans: DataFrame, year: int) -> DataFrame:
    moves = _with_next(subscriptions, plans)
    stayed = moves.filter((F.col("plan_id") == TRIAL) & (F.col("plan_n") != CHURN))
    return _by_month(stayed, year, "New_customers")


def churn_by_month(subscriptions: DataFrame, plans: DataFrame, year: int) -> DataFrame:
    churned = _known(subscriptions, plans).filter(F.col("plan_id") == CHURN)
    return _by_month(churned, year, "churn_customers")


def new_to_churn_ratio(
    subscriptions: DataFrame, plans: DataFrame, year: int, keep_all: bool = False
) -> DataFrame:
    """New over churned customers; `keep_all` also shows months that lack one of them."""
    new = new_customers_by_month(subscriptions, plans, year)
    churned = churn_by_month(subscriptions, plans, year)
    both = new.join(churned, "Month", "full" if keep_all else "inner")
    counted = [F.coalesce(c, F.lit(0)) for c in ("New_customers", "churn_customers")]
    return both.select("Month", ratio(*counted, 2).alias("new_churn_ratio"))


def churn_by_from_plan(
    subscriptions: DataFrame, plans: DataFrame, order: str = "plan_id"
) -> DataFrame:
    left = _with_next(subscriptions, plans, order).filter(F.col("plan_n") == CHURN)
    return left.groupBy("plan_id").agg(F.count(F.lit(1)).alias("churn_counts"))
