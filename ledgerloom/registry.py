"""Every job on the inputs derived from a table folder.

`QUERIES` maps a key to a function of (spark, folder). Keys carry the number of the
question; a suffix names a variant that gives the asked answer where the default
keeps the answer as written.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.ordered import PAGE
from .plans import across, clickstream, delivery, loyalty, segments, subscriptions, weekly
from .sources import clickstream as c_in
from .sources import delivery as d_in
from .sources import loyalty as r_in
from .sources import segments as i_in
from .sources import subscriptions as s_in
from .sources import weekly as w_in
from .sources.tables import declared, read_table

Query = Callable[[SparkSession, str], DataFrame]

NEW_PIZZA = (0, "Supreme", "1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12")


def _resolved(options: dict) -> dict:
    """Column options are given as functions, since a column needs a running session."""
    return {name: value() if callable(value) else value for name, value in options.items()}


def _loyalty() -> dict[str, Query]:
    def job(function, inputs: str, **options) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            tables = [
                declared(getattr(r_in, name)(spark, folder), name) for name in inputs.split()
            ]
            return function(*tables, **_resolved(options))

        return run

    def bonus():
        return F.col("product_id") % r_in.BONUS_EVERY == 1

    def promo_end():
        return F.date_add("join_date", r_in.PROMO_DAYS)

    all_three = "sales menu members"
    return {
        "r01_spend_per_customer": job(loyalty.spend_per_customer, "sales menu"),
        "r02_visit_days": job(loyalty.visit_days, "sales"),
        "r03_first_item": job(loyalty.first_item, "sales menu"),
        "r04_most_purchased_item": job(loyalty.most_purchased_item, "sales menu"),
        "r05_favourite_item": job(loyalty.favourite_item, "sales menu"),
        "r06_first_item_after_join": job(loyalty.first_item_after_join, all_three),
        "r07_items_before_join": job(loyalty.items_before_join, all_three),
        "r07_items_before_join_last_only": job(
            loyalty.items_before_join, all_three, last_only=True
        ),
        "r08_totals_before_join": job(loyalty.totals_before_join, all_three),
        "r09_loyalty_points": job(loyalty.loyalty_points, "sales menu", bonus=bonus),
        "r10_promo_window_points": job(loyalty.promo_window_points, all_three, end=promo_end),
        "r11_member_flagged_orders": job(loyalty.member_flagged_orders, all_three),
        "r12_member_order_rank": job(loyalty.member_order_rank, all_three),
    }


def _delivery() -> dict[str, Query]:
    def job(function, inputs: str, pick: int | None = None, **options) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            tables = [
                d_in.pizza_toppings(spark)
                if name == "pizza_toppings"
                else declared(getattr(d_in, name)(spark, folder), name)
                for name in inputs.split()
            ]
            result = function(*tables, **_resolved(options))
            return result if pick is None else result[pick]

        return run

    def premium():
        return F.col("pizza_id") % 2 == 1

    lines, runs, both = "customer_orders", "runner_orders", "customer_orders runner_orders"
    menu = "pizza_recipes pizza_toppings"
    pizza_id, name, toppings = NEW_PIZZA
    add = partial(job, delivery.append_menu_item, "pizza_names pizza_recipes",
                  pizza_id=pizza_id, name=name, toppings=toppings)
    return {
        "d01_items_ordered": job(delivery.items_ordered, lines),
        "d02_unique_customers": job(delivery.unique_customers, lines),
        "d03_successful_orders": job(delivery.successful_orders, runs),
        "d03_successful_orders_per_runner": job(delivery.successful_orders, runs, per_runner=True),
        "d04_delivered_by_type": job(delivery.delivered_by_type, both),
        "d05_type_by_customer": job(delivery.type_by_customer, lines),
        "d06_max_items_per_order": job(delivery.max_items_per_order, lines),
        "d07_changes_per_customer": job(delivery.changes_per_customer, both),
        "d08_both_changes_count": job(delivery.both_changes_count, both),
        "d09_volume_hour_day": job(delivery.volume_hour_day, lines),
        "d10_volume_day_week": job(delivery.volume_day_week, lines),
        "d11_signups_by_week": job(delivery.signups_by_week, "runners"),
        "d12_avg_pickup_minutes": job(delivery.avg_pickup_minutes, both),
        "d12_avg_pickup_minutes_per_order": job(delivery.avg_pickup_minutes, both, per="order"),
        "d13_prep_time_vs_items": job(delivery.prep_time_vs_items, both),
        "d14_avg_distance": job(delivery.avg_distance, both),
        "d14_avg_distance_per_order": job(delivery.avg_distance, both, per="order"),
        "d15_duration_spread": job(delivery.duration_spread, runs),
        "d16_avg_speed": job(delivery.avg_speed, runs),
        "d17_delivery_pct": job(delivery.delivery_pct, runs),
        "d17_delivery_pct_as_written": job(delivery.delivery_pct, runs, as_written=True),
        "d18_clean_orders": job(delivery.clean_orders, lines),
        "d19_explode_extras": job(delivery.explode_extras, lines),
        "d20_explode_exclusions": job(delivery.explode_exclusions, lines),
        "d21_standard_ingredients": job(delivery.standard_ingredients, menu),
        "d22_top_extra": job(delivery.top_extra, lines),
        "d23_top_exclusion": job(delivery.top_exclusion, lines),
        "d24_order_description": job(
            delivery.order_description, "customer_orders pizza_names pizza_toppings"
        ),
        "d25_cleaned_toppings": job(delivery.cleaned_toppings, menu),
        "d26_ingredient_usage": job(delivery.ingredient_usage, f"{lines} {menu}"),
        "d26_ingredient_list": job(delivery.ingredient_list, f"{lines} {menu}"),
        "d27_ingredient_usage_delivered": job(
            delivery.ingredient_usage_delivered, f"{both} {menu}"
        ),
        "d27_ingredient_usage_delivered_only": job(
            delivery.ingredient_usage_delivered, f"{both} {menu}", delivered_only=True
        ),
        "d28_revenue_per_runner": job(delivery.revenue_per_runner, both, premium=premium),
        "d29_revenue_with_extras": job(delivery.revenue_with_extras, both, premium=premium),
        "d30_order_total_time": job(delivery.order_total_time, both),
        "d31_runner_ratings": job(delivery.runner_ratings, both),
        "d31_runner_ratings_per_order": job(delivery.runner_ratings, both, per="order"),
        "d32_customer_order_counts": job(delivery.customer_order_counts, lines),
        "d33_delivery_fact": job(delivery.delivery_fact, both),
        "d34_earnings_with_distance": job(
            delivery.earnings_with_distance, both, premium=premium
        ),
        "d34_earnings_minus_distance": job(
            delivery.earnings_with_distance, both, premium=premium, sign=-1, per="order"
        ),
        "d35_append_menu_item_names": add(pick=0),
        "d35_append_menu_item_recipes": add(pick=1),
    }


def _subscriptions() -> dict[str, Query]:
    year = s_in.YEAR

    def job(function, with_plans: bool = True, **options) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            plans = [declared(s_in.plans(spark), "plans")] if with_plans else []
            rows = declared(s_in.subscriptions(spark, folder), "subscriptions")
            return function(rows, *plans, **options)

        return run

    subs = subscriptions
    return {
        "s01_customer_journey": job(subs.customer_journey),
        "s02_total_customers": job(subs.total_customers, False),
        "s03_trials_by_month": job(subs.trials_by_month, False),
        "s04_events_before_after_cutoff": job(
            subs.events_before_after_cutoff, cutoff=f"{year + 1}-01-01"
        ),
        "s05_churn_pct": job(subs.churn_pct, False),
        "s06_churn_after_trial": job(subs.churn_after_trial),
        "s07_next_plan_after_trial": job(subs.next_plan_after_trial),
        "s07_next_plan_after_trial_by_date": job(subs.next_plan_after_trial, order="start_date"),
        "s08_plan_mix_at_date": job(subs.plan_mix_at_date, False, as_of=f"{year}-12-31"),
        "s08_plan_mix_at_date_inclusive": job(
            subs.plan_mix_at_date, False, as_of=f"{year}-12-31", as_written=False
        ),
        "s09_annual_upgrades": job(subs.annual_upgrades, year=year),
        "s09_annual_upgrades_by_date": job(subs.annual_upgrades, year=year, order="start_date"),
        "s10_avg_days_to_annual": job(subs.avg_days_to_annual, False),
        "s11_days_to_annual_histogram": job(subs.days_to_annual_histogram, False),
        "s12_downgrades": job(subs.downgrades, year=year),
        "s12_downgrades_by_date": job(subs.downgrades, year=year, order="start_date"),
        "s13_payment_schedule": job(subs.payment_schedule, year=year),
        "s14_pro_plan_month_ratio": job(subs.pro_plan_month_ratio, year=year),
        "s15_upgrade_month_ratio": job(subs.upgrade_month_ratio, year=year),
        "s15_upgrade_month_ratio_by_date": job(
            subs.upgrade_month_ratio, year=year, order="start_date"
        ),
        "s16_growth_joined": job(subs.growth_joined, year=year),
        "s17_new_customers_by_month": job(subs.new_customers_by_month, year=year),
        "s18_churn_by_month": job(subs.churn_by_month, year=year),
        "s19_new_to_churn_ratio": job(subs.new_to_churn_ratio, year=year),
        "s19_new_to_churn_ratio_all_months": job(
            subs.new_to_churn_ratio, year=year, keep_all=True
        ),
        "s20_churn_by_from_plan": job(subs.churn_by_from_plan),
        "s20_churn_by_from_plan_by_date": job(subs.churn_by_from_plan, order="start_date"),
    }


def _weekly() -> dict[str, Query]:
    pivot, years = w_in.PIVOT, w_in.YEARS
    pivot_year = int(pivot[:4])

    def job(function, **options) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            sales = declared(w_in.weekly_sales(spark, folder), "weekly_sales")
            clean = weekly.clean_weekly_sales(sales)
            return function(clean, **options)

        return run

    found = {
        "w01_clean_weekly_sales": job(lambda clean: clean),
        "w02_weekday_names": job(weekly.weekday_names),
        "w03_week_numbers_present": job(weekly.week_numbers_present),
        "w03_missing_weeks": job(weekly.missing_weeks),
        "w03_missing_weeks_per_year_region": job(
            weekly.missing_weeks, by=("calendar_year", "region")
        ),
        "w04_tx_by_year": job(weekly.tx_by_year),
        "w05_sales_region_month": job(weekly.sales_region_month),
        "w06_tx_by_platform": job(weekly.tx_by_platform),
        "w07_platform_share_month": job(weekly.platform_share_month),
        "w08_platform_share_region": job(weekly.platform_share_region),
        "w08_platform_share_demographic": job(weekly.platform_share_region, dim="demographic"),
        "w09_retail_share_by_segment": job(weekly.retail_share_by_segment),
        "w10_avg_transaction_compare": job(weekly.avg_transaction_compare),
        "w11_before_after_4w": job(weekly.before_after_4w, pivot=pivot),
        "w11_before_after_4w_same_year": job(weekly.before_after_4w, pivot=pivot, same_year=True),
        "w12_before_after_12w": job(weekly.before_after_12w, pivot=pivot),
        "w12_before_after_12w_same_year": job(
            weekly.before_after_12w, pivot=pivot, same_year=True
        ),
        "w13_before_after_vs_years": job(weekly.before_after_vs_years, pivot=pivot, years=years),
    }
    for number, dim in zip(range(14, 19), weekly.DIMENSIONS):
        found[f"w{number}_impact_{dim}"] = job(weekly.impact, dim=dim)
    found["w19_worst_area_union"] = job(weekly.worst_area_union)
    found["w19_worst_area_union_same_year"] = job(weekly.worst_area_union, same_year=pivot_year)
    return found


def _clickstream() -> dict[str, Query]:
    small = {"page_hierarchy", "event_identifier", "campaign_identifier"}

    def job(function, inputs: str, **options) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            tables = [
                declared(
                    getattr(c_in, name)(spark)
                    if name in small
                    else getattr(c_in, name)(spark, folder),
                    name,
                )
                for name in inputs.split()
            ]
            return function(*tables, **options)

        return run

    log, pages = "site_events", "site_events page_hierarchy"
    campaigns = "site_events users page_hierarchy campaign_identifier"
    kinds = f"{pages} event_identifier"
    click = clickstream
    return {
        "c01_user_count": job(click.user_count, "users"),
        "c02_avg_cookies": job(click.avg_cookies, "users"),
        "c03_visits_by_month": job(click.visits_by_month, log),
        "c04_events_by_type": job(click.events_by_type, log),
        "c05_purchase_pct": job(click.purchase_pct, log),
        "c06_checkout_no_purchase": job(click.checkout_no_purchase, log),
        "c07_top_pages": job(click.top_pages, pages),
        "c08_category_views_adds": job(click.category_views_adds, kinds),
        "c08_category_views_adds_all": job(click.category_views_adds, kinds, keep_all=True),
        "c09_top_products": job(click.top_products, pages),
        "c10_view_counts": job(click.view_counts, pages),
        "c11_add_counts": job(click.add_counts, pages),
        "c12_abandon_counts": job(click.abandon_counts, pages),
        "c13_purchase_counts": job(click.purchase_counts, pages),
        "c14_product_funnel": job(click.product_funnel, pages),
        "c14_product_funnel_all": job(click.product_funnel, pages, keep_all=True),
        "c15_category_funnel": job(click.category_funnel, pages),
        "c16_funnel_leaders": job(click.funnel_leaders, pages),
        "c17_most_abandoned": job(click.most_abandoned, pages),
        "c18_view_purchase_ratio": job(click.view_purchase_ratio, pages),
        "c19_view_to_cart_rate": job(click.view_to_cart_rate, pages),
        "c20_cart_to_purchase_rate": job(click.cart_to_purchase_rate, pages),
        "c21_campaign_visits": job(click.campaign_visits, campaigns),
        "c22_users_in_all_campaigns": job(click.users_in_all_campaigns, campaigns),
        "c23_impressed_vs_not": job(click.impressed_vs_not, campaigns),
        "c24_click_purchase_rate": job(click.click_purchase_rate, campaigns),
        "c25_campaign_uplift": job(click.campaign_uplift, campaigns),
    }


def _segments() -> dict[str, Query]:
    months = i_in.MIN_MONTHS

    def job(
        function, with_map: bool = False, ranks: bool = False, nulls: bool = False,
        filtered: bool = False, **options,
    ) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            metrics = i_in.interest_metrics(spark, folder, ranks)
            if ranks:
                declared(metrics, "interest_metrics")
            if not nulls:
                metrics = segments.drop_null_months(metrics)
            metrics = segments.month_year_to_date(metrics)
            if filtered:
                metrics = segments.filtered_metrics(metrics, months)
            maps = [declared(i_in.interest_map(spark, folder), "interest_map")] if with_map else []
            return function(metrics, *maps, **options)

        return run

    def map_count(spark: SparkSession, folder: str) -> DataFrame:
        return segments.map_count(i_in.interest_map(spark, folder))

    seg = segments
    on_segments = {"with_map": True, "filtered": True}
    return {
        "i01_month_year_to_date": job(lambda metrics: metrics, ranks=True, nulls=True),
        "i02_records_by_month": job(seg.records_by_month, nulls=True),
        "i02_records_by_month_oldest": job(seg.records_by_month, nulls=True, order="oldest"),
        "i03_null_month_count": job(seg.null_month_count, nulls=True),
        "i03_null_month_count_after": job(seg.null_month_count),
        "i04_drop_null_months": job(lambda metrics: metrics, ranks=True),
        "i05_reconcile_ids": job(seg.reconcile_ids, True),
        "i06_map_count": map_count,
        "i07_joined_interest": job(seg.joined_interest, True, ranks=True),
        "i08_month_before_created": job(seg.month_before_created, True, ranks=True),
        "i09_always_present": job(seg.always_present),
        "i10_cumulative_pct": job(seg.cumulative_pct),
        "i11_rows_below_threshold": job(seg.rows_below_threshold, months=months),
        "i12_interests_per_month": job(seg.interests_per_month, more_than=months - 1),
        "i13_filtered_metrics": job(seg.filtered_metrics, ranks=True, months=months),
        "i14_top10_composition": job(seg.extreme_composition, **on_segments),
        "i14_top10_composition_per_interest": job(
            seg.extreme_composition, **on_segments, per_interest=True
        ),
        "i15_bottom10_composition": job(seg.extreme_composition, **on_segments, lowest=True),
        "i15_bottom10_composition_per_interest": job(
            seg.extreme_composition, **on_segments, lowest=True, per_interest=True
        ),
        "i16_worst_ranking5": job(seg.worst_ranking5, **on_segments, ranks=True),
        "i17_most_variable5": job(seg.most_variable5, **on_segments, ranks=True),
        "i18_percentile_extremes": job(seg.percentile_extremes, **on_segments, ranks=True),
        "i18_percentile_extremes_per_interest": job(
            seg.percentile_extremes, **on_segments, ranks=True, per_interest=True
        ),
        "i18_percentile_extremes_all_interests": job(
            seg.percentile_extremes, **on_segments, ranks=True, five_only=False
        ),
        "i19_monthly_top10": job(seg.monthly_top10, True),
        "i20_most_frequent_top10": job(seg.most_frequent_top10, True),
        "i21_avg_of_avg_comp": job(seg.avg_of_avg_comp, True),
        "i22_rolling3_with_leaders": job(seg.rolling3_with_leaders, True, after=i_in.AFTER),
    }


def _across() -> dict[str, Query]:
    def stored(function, *names: str, **options) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(*[read_table(spark, folder, name) for name in names], **options)

        return run

    def with_promotions(function) -> Query:
        return lambda spark, folder: function(
            read_table(spark, folder, "events"), c_in.promotions(spark, folder)
        )

    def plan_as_of(spark: SparkSession, folder: str) -> DataFrame:
        states = declared(s_in.subscriptions(spark, folder), "subscriptions")
        return across.order_plan_as_of(read_table(spark, folder, "orders"), states)

    def impact_by_each(spark: SparkSession, folder: str) -> DataFrame:
        sales = declared(w_in.weekly_sales(spark, folder), "weekly_sales")
        return across.impact_by_each(weekly.clean_weekly_sales(sales))

    return {
        "j08_promotion_totals": with_promotions(across.promotion_totals),
        "j08_purchases_in_promotions": with_promotions(across.purchases_in_promotions),
        "o04_order_plan_as_of": plan_as_of,
        "n06_order_neighbours": stored(across.order_neighbours, "orders", page=PAGE),
        "n03_order_ranks": stored(across.order_ranks, "orders"),
        "o10_step_funnel": stored(across.step_funnel, "events", gap=None),
        "o10_step_funnel_half_day": stored(across.step_funnel, "events", gap="'12' HOUR"),
        "a04_customers_by_period": stored(across.customers_by_period, "orders"),
        "o09_impact_by_each": impact_by_each,
        "o13_order_changes": stored(across.order_changes, "orders"),
        "o14_order_month_runs": stored(across.order_month_runs, "orders"),
        "o14_order_month_summary": stored(across.order_month_summary, "orders"),
    }


QUERIES: dict[str, Query] = {
    **_loyalty(), **_delivery(), **_subscriptions(), **_weekly(), **_clickstream(), **_segments(),
    **_across(),
}
