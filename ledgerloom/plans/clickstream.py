"""Clickstream: visits, product funnel, campaigns.

Inputs: site_events(visit_id, cookie_id, page_id, event_type, event_time), users,
page_hierarchy, event_identifier, campaign_identifier.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import cut_ratio, decimal_avg, percent, ratio, truncated_avg
from ..operators.compare import cohort_compare
from ..operators.funnel import attribute, funnel
from ..operators.lists import render_list
from ..operators.topn import top_n

VIEW, ADD, PURCHASE, IMPRESSION, CLICK = range(1, 6)
CHECKOUT, CONFIRMATION = 12, 13
# Pages that show no product.
PLAIN_PAGES = (1, 2, CHECKOUT, CONFIRMATION)


def _is(kind: int) -> Column:
    return F.col("event_type") == kind


def user_count(users: DataFrame) -> DataFrame:
    return users.agg(F.count_distinct("user_id").alias("usr_count"))


def avg_cookies(users: DataFrame) -> DataFrame:
    counts = users.groupBy("user_id").agg(F.count("cookie_id").alias("c_count"))
    return counts.agg(decimal_avg(F.col("c_count"), 2).alias("avg_c_count"))


def visits_by_month(events: DataFrame) -> DataFrame:
    month = F.month("event_time").alias("Month")
    visits = F.count_distinct("visit_id").alias("unq_visits")
    return events.groupBy(month).agg(visits).orderBy("Month")


def events_by_type(events: DataFrame) -> DataFrame:
    count = F.count("event_type").alias("evnt_count")
    return events.groupBy("event_type").agg(count).orderBy("event_type")


def purchase_pct(events: DataFrame) -> DataFrame:
    """Rows on the confirmation page per distinct visit, in percent."""
    visits = events.groupBy("visit_id").agg(
        F.count_if(F.col("visit_id").isNotNull() & (F.col("page_id") == CONFIRMATION)).alias("n")
    )
    share = percent(F.sum("n"), F.count("visit_id"))
    return visits.agg(share.alias("purchase_percentage"))


def checkout_no_purchase(events: DataFrame) -> DataFrame:
    """Checkout rows of visits without a purchase per checkout row, in percent."""
    visits = events.filter(F.col("visit_id").isNotNull()).groupBy("visit_id").agg(
        F.count_if(F.col("page_id") == CHECKOUT).alias("n"), F.max(_is(PURCHASE)).alias("bought")
    )
    left = F.sum(F.when(~F.col("bought"), F.col("n")).otherwise(0))
    return visits.agg(percent(left, F.sum("n")).alias("checkout_percentage"))


def _page_counts(events: DataFrame, pages: DataFrame, kind: int, name: str) -> DataFrame:
    """Events of a kind per page name; counted per page id before the name is looked up."""
    counts = events.filter(_is(kind)).groupBy("page_id").agg(F.count("page_id").alias("n"))
    return counts.join(pages, "page_id").groupBy("page_name").agg(F.sum("n").alias(name))


def top_pages(events: DataFrame, pages: DataFrame, n: int = 3) -> DataFrame:
    return top_n(view_counts(events, pages), "page_count", n, ["page_name"])


def category_views_adds(
    events: DataFrame, pages: DataFrame, kinds: DataFrame, keep_all: bool = False
) -> DataFrame:
    """Views and cart adds per category; `keep_all` also shows categories that lack one."""
    known = kinds.filter(F.col("event_type") == ADD).select(F.col("event_type").alias("_kind"))
    counts = events.groupBy("page_id", "event_type").agg(F.count("page_id").alias("n"))
    named = counts.join(pages.filter(F.col("product_category").isNotNull()), "page_id")
    typed = named.join(known, F.col("event_type") == F.col("_kind"), "left")
    adds = _is(ADD) & F.col("_kind").isNotNull()
    sums = typed.groupBy("product_category").agg(
        F.sum(F.when(_is(VIEW), F.col("n")).otherwise(0)).alias("view_count"),
        F.sum(F.when(adds, F.col("n")).otherwise(0)).alias("add_count"),
    )
    return sums if keep_all else sums.filter((F.col("view_count") > 0) & (F.col("add_count") > 0))


def _per_page(events: DataFrame, pages: DataFrame) -> DataFrame:
    steps = funnel(events, "visit_id", "page_id", _is(VIEW), _is(ADD), _is(PURCHASE))
    named = steps.join(pages, "page_id")
    return named.groupBy("page_name").agg(
        *[F.sum(c).alias(c) for c in ("views", "adds", "abandoned", "purchased")]
    )


def _step(events: DataFrame, pages: DataFrame, column: str, name: str) -> DataFrame:
    counts = _per_page(events, pages).filter(F.col(column) > 0)
    return counts.select("page_name", F.col(column).alias(name))


def top_products(events: DataFrame, pages: DataFrame, n: int = 3) -> DataFrame:
    return top_n(purchase_counts(events, pages), "purchase_count", n, ["page_name"])


def view_counts(events: DataFrame, pages: DataFrame) -> DataFrame:
    return _page_counts(events, pages, VIEW, "page_count")


def add_counts(events: DataFrame, pages: DataFrame) -> DataFrame:
    return _page_counts(events, pages, ADD, "add_count")


def abandon_counts(events: DataFrame, pages: DataFrame) -> DataFrame:
    return _step(events, pages, "abandoned", "abandon_count")


def purchase_counts(events: DataFrame, pages: DataFrame) -> DataFrame:
    return _step(events, pages, "purchased", "purchase_count")


def product_funnel(events: DataFrame, pages: DataFrame, keep_all: bool = False) -> DataFrame:
    """The four counts per product, from one pass over the events.

    As written a product that misses any count is lost; `keep_all` keeps it with 0.
    """
    counts = _per_page(events, pages)
    if not keep_all:
        some = [F.col(c) > 0 for c in ("views", "adds", "abandoned", "purchased")]
        counts = counts.filter(reduce(Column.__and__, some))
    return counts.join(pages, "page_name").select(
        "product_id",
        F.col("page_name").alias("product_name"),
        "product_category",
        F.col("views").alias("page_count"),
        F.col("adds").alias("add_count"),
        F.col("abandoned").alias("abandon_count"),
        F.col("purchased").alias("purchase_count"),
    )


def category_funnel(events: DataFrame, pages: DataFrame) -> DataFrame:
    counts = ("page_count", "add_count", "abandon_count", "purchase_count")
    return product_funnel(events, pages).groupBy("product_category").agg(
        *[F.sum(c).alias(c) for c in counts]
    )


def funnel_leaders(events: DataFrame, pages: DataFrame) -> DataFrame:
    """The leading product of each count, picked in one aggregate; ties to the first name."""
    products = product_funnel(events, pages)
    labels = {
        "Most Viewed": "page_count",
        "Most Cart Add": "add_count",
        "Most Purchases": "purchase_count",
    }
    best = products.agg(
        *[F.min(F.struct((-F.col(c)).alias("n"), "product_name")).alias(c) for c in labels.values()]
    ).filter(F.col("page_count").isNotNull())
    rows = [
        F.struct(
            F.lit(label).alias("Most"),
            F.col(c)["product_name"].alias("product_name"),
            (-F.col(c)["n"]).alias("page_count"),
        )
        for label, c in labels.items()
    ]
    return best.select(F.inline(F.array(*rows)))


def most_abandoned(events: DataFrame, pages: DataFrame) -> DataFrame:
    products = product_funnel(events, pages).select("product_name", "abandon_count")
    return top_n(products, "abandon_count", 1, ["product_name"])


def view_purchase_ratio(events: DataFrame, pages: DataFrame) -> DataFrame:
    views = ratio(F.col("page_count"), F.col("purchase_count"), 2).alias("p_p_ratio")
    products = product_funnel(events, pages).select("product_name", views)
    return top_n(products, "p_p_ratio", 1, ["product_name"])


def _avg_rate(events: DataFrame, pages: DataFrame, num: str, den: str) -> DataFrame:
    rates = product_funnel(events, pages).select(percent(F.col(num), F.col(den)).alias("rate"))
    return rates.agg(decimal_avg(F.col("rate"), 2).alias("avg_conv"))


def view_to_cart_rate(events: DataFrame, pages: DataFrame) -> DataFrame:
    return _avg_rate(events, pages, "add_count", "page_count")


def cart_to_purchase_rate(events: DataFrame, pages: DataFrame) -> DataFrame:
    return _avg_rate(events, pages, "purchase_count", "add_count")


# Campaigns


def _visit_products(events: DataFrame, pages: DataFrame) -> DataFrame:
    """Product pages of each visit as text in time order, put together minute by minute."""
    product_pages = pages.filter(~F.col("page_id").isin(*PLAIN_PAGES))
    seen = events.join(product_pages, "page_id").select(
        "visit_id", "event_time", "page_name", F.date_trunc("minute", "event_time").alias("_minute")
    )
    return render_list(
        seen, ["visit_id"], ["event_time", "page_name"], "page_name", "cart_prod", block="_minute"
    )


def _visit_facts(
    events: DataFrame, users: DataFrame, pages: DataFrame, campaigns: DataFrame
) -> DataFrame:
    """Counts per user, visit and campaign, for visits that saw a product page.

    Events are summed per visit, cookie and campaign before they meet the users; whether
    the visit saw a product page is one more such sum, over events of no campaign as well.
    """
    products = pages.filter(~F.col("page_id").isin(*PLAIN_PAGES)).select(
        "page_id", F.lit(True).alias("product")
    )
    marked = events.join(products, "page_id", "left")
    names = ("view_count", "cart_count", "purchase", "impression", "click")
    kinds = (VIEW, ADD, PURCHASE, IMPRESSION, CLICK)
    placed = attribute(
        marked, campaigns, "event_time", "start_date", "end_date", "campaign_name"
    )
    per_cookie = placed.groupBy("visit_id", "cookie_id", "campaign_name").agg(
        F.min("event_time").alias("visit_start_time"),
        F.max("product").alias("product"),
        *[F.count_if(_is(kind)).alias(name) for kind, name in zip(kinds, names)],
    )
    # A visit has a few cookies and campaigns, so its window is short.
    saw = F.max("product").over(Window.partitionBy("visit_id"))
    seen = per_cookie.withColumn("saw", saw).filter("saw AND campaign_name IS NOT NULL")
    return (
        seen.join(users, "cookie_id")
        .groupBy("user_id", "visit_id", "campaign_name")
        .agg(
            F.min("visit_start_time").alias("visit_start_time"),
            *[F.sum(name).alias(name) for name in names],
        )
    )


def campaign_visits(
    events: DataFrame, users: DataFrame, pages: DataFrame, campaigns: DataFrame
) -> DataFrame:
    facts = _visit_facts(events, users, pages, campaigns)
    return facts.join(_visit_products(events, pages), "visit_id").select(
        "user_id", "visit_id", "visit_start_time", "view_count", "cart_count", "purchase",
        "campaign_name", "impression", "click", "cart_prod",
    )


def _campaigns_seen() -> Column:
    """Distinct campaigns of the user's visits that had an impression."""
    return F.count_distinct(F.when(F.col("impression") != 0, F.col("campaign_name")))


def users_in_all_campaigns(
    events: DataFrame, users: DataFrame, pages: DataFrame, campaigns: DataFrame, n: int = 3
) -> DataFrame:
    visits = _visit_facts(events, users, pages, campaigns)
    counts = visits.groupBy("user_id").agg(_campaigns_seen().alias("imp_count"))
    return counts.filter(F.col("imp_count") == n)


def impressed_vs_not(
    events: DataFrame, users: DataFrame, pages: DataFrame, campaigns: DataFrame, n: int = 3
) -> DataFrame:
    """Averages per user, then over users, for users impressed in all campaigns and others.

    Whole-number averages drop the fraction at both levels, as written.
    """
    per_user = _visit_facts(events, users, pages, campaigns).groupBy("user_id").agg(
        (_campaigns_seen() == n).alias("impressed"),
        truncated_avg(F.col("view_count")).alias("vc"),
        truncated_avg(F.col("cart_count")).alias("cc"),
        cut_ratio(F.sum("purchase"), F.count("purchase")).alias("p"),
    )
    impressed = F.col("impressed")
    cohorts = cohort_compare(
        per_user,
        {"imp_user": impressed, "non_imp_user": ~impressed},
        {
            "view_count": lambda test: truncated_avg(F.when(test, F.col("vc"))),
            "cart_count": lambda test: truncated_avg(F.when(test, F.col("cc"))),
            "purchase": lambda test: cut_ratio(
                F.sum(F.when(test, F.col("p"))), F.count(F.when(test, F.col("p")))
            ),
        },
        "user_type",
    )
    return cohorts.filter(F.col("purchase").isNotNull())


def _rate(hit: Column, base: Column) -> Column:
    """Share of the base visits that hit, cut to six digits and then made a percentage."""
    return (cut_ratio(F.count_if(hit), F.count_if(base)) * 100).cast("decimal(18,6)")


def click_purchase_rate(
    events: DataFrame, users: DataFrame, pages: DataFrame, campaigns: DataFrame
) -> DataFrame:
    """Purchase and non-purchase share of the visits with one click."""
    clicked = F.col("click") == 1
    return cohort_compare(
        _visit_facts(events, users, pages, campaigns),
        {"click_user": F.col("purchase") == 1, "non_click_user": F.col("purchase") == 0},
        {"purchase_rate": lambda test: _rate(clicked & test, clicked)},
        "user_type",
    )


def campaign_uplift(
    events: DataFrame, users: DataFrame, pages: DataFrame, campaigns: DataFrame
) -> DataFrame:
    """Purchases per visit among clicking, impressed-only and not impressed visits.

    The last two share one label as written (equal rows then merge in the union);
    here each has its own, so all three rows stay.
    """
    bought = F.col("purchase") == 1
    shown, clicked = F.col("impression") == 1, F.col("click") == 1
    return cohort_compare(
        _visit_facts(events, users, pages, campaigns),
        {
            "click_user": clicked & bought,
            "non_click_user": shown & (F.col("click") == 0) & bought,
            "non_impression_user": (F.col("impression") == 0) & bought,
        },
        {"purchase_rate": lambda test: _rate(test, F.lit(True))},
        "user_type",
    )
