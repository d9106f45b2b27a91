"""Clickstream inputs from the event log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# Event type numbers and names.
EVENT_TYPES = [
    (1, "Page View"),
    (2, "Add to Cart"),
    (3, "Purchase"),
    (4, "Ad Impression"),
    (5, "Ad Click"),
]
# Page id, name, category, product id.
PAGES = [
    (1, "Home Page", None, None),
    (2, "All Products", None, None),
    (3, "Salmon", "Fish", 1),
    (4, "Kingfish", "Fish", 2),
    (5, "Tuna", "Fish", 3),
    (6, "Caviar", "Luxury", 4),
    (7, "Truffle", "Luxury", 5),
    (8, "Abalone", "Shellfish", 6),
    (9, "Lobster", "Shellfish", 7),
    (10, "Crab", "Shellfish", 8),
    (11, "Oyster", "Shellfish", 9),
    (12, "Checkout", None, None),
    (13, "Confirmation", None, None),
]
# Campaign name, first day, last day.
CAMPAIGNS = [
    ("Early January", "2024-01-01", "2024-01-10"),
    ("Mid January", "2024-01-11", "2024-01-20"),
    ("Late January", "2024-01-21", "2024-01-28"),
]


def site_events(spark: SparkSession, folder: str) -> DataFrame:
    """Visits are user and day; the number in `props` gives the page."""
    log = read_table(spark, folder, "events")
    user = F.col("user_id").cast("string")
    number = F.get_json_object("props", "$.k").cast("int")
    day = F.col("ts").cast("date").cast("string")
    kind = F.col("event_type")
    return log.select(
        F.concat(user, F.lit("-"), F.translate(day, "-", "")).alias("visit_id"),
        F.concat(user, F.lit("-"), (F.col("event_id") % 3).cast("string")).alias("cookie_id"),
        (number % 13 + 1).alias("page_id"),
        F.when(kind == "view", 1).when(kind == "click", 2).when(kind == "purchase", 3)
        .when((kind == "signup") & (number < 25), 4).when(kind == "signup", 1).otherwise(5)
        .alias("event_type"),
        F.col("ts").alias("event_time"),
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    log = read_table(spark, folder, "events")
    cookie = F.concat(
        F.col("user_id").cast("string"), F.lit("-"), (F.col("event_id") % 3).cast("string")
    )
    return log.select("user_id", cookie.alias("cookie_id")).distinct()


def page_hierarchy(spark: SparkSession) -> DataFrame:
    def cell(value):
        return "NULL" if value is None else repr(value)

    rows = ", ".join(f"({', '.join(cell(v) for v in page)})" for page in PAGES)
    return spark.sql(
        f"SELECT * FROM VALUES {rows} AS t(page_id, page_name, product_category, product_id)"
    )


def event_identifier(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"({number}, '{name}')" for number, name in EVENT_TYPES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(event_type, event_name)")


def campaign_identifier(spark: SparkSession) -> DataFrame:
    rows = ", ".join(
        f"('{name}', TIMESTAMP_NTZ'{first} 00:00:00', TIMESTAMP_NTZ'{last} 23:59:59.999999')"
        for name, first, last in CAMPAIGNS
    )
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(campaign_name, start_date, end_date)")


def promotions(spark: SparkSession, folder: str) -> DataFrame:
    """One promotion per supplier; they last from one second to more than eight years."""
    number = F.col("s_suppkey")
    seconds = lambda n: F.make_dt_interval(secs=n.cast("decimal(18,6)"))
    starts = F.lit("2024-01-01").cast("timestamp_ntz") + seconds(number * 7919 % 2_592_000)
    lasts = F.pow(F.lit(2), number % 29).cast("long")
    found = read_table(spark, folder, "supplier").select(number.alias("promotion_id"), starts.alias("starts"), lasts.alias("s"))
    return found.select("promotion_id", "starts", (F.col("starts") + seconds(F.col("s"))).alias("ends"))
