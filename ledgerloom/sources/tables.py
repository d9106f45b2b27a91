"""Stored tables with fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Columns of the stored tables.
STORED = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE,"
    " c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,"
    " p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,"
    " l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,"
    " l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,"
    " value DOUBLE, props STRING",
}

# Columns of the job inputs.
INPUTS = {
    "sales": "customer_id BIGINT, order_date DATE, product_id BIGINT",
    "menu": "product_id BIGINT, product_name STRING, price DECIMAL(18,2)",
    "members": "customer_id BIGINT, join_date DATE",
    "runners": "runner_id BIGINT, registration_date DATE",
    "customer_orders": "order_id BIGINT, customer_id BIGINT, pizza_id BIGINT, exclusions STRING,"
    " extras STRING, order_time TIMESTAMP_NTZ",
    "runner_orders": "order_id BIGINT, runner_id BIGINT, pickup_time STRING, distance STRING,"
    " duration STRING, cancellation STRING",
    "pizza_names": "pizza_id BIGINT, pizza_name STRING",
    "pizza_recipes": "pizza_id BIGINT, toppings STRING",
    "pizza_toppings": "topping_id INT, topping_name STRING",
    "subscriptions": "customer_id BIGINT, plan_id INT, start_date DATE",
    "plans": "plan_id INT, plan_name STRING, price DECIMAL(18,2)",
    "weekly_sales": "week_date STRING, region STRING, platform STRING, segment STRING,"
    " customer_type STRING, transactions BIGINT, sales BIGINT",
    "users": "user_id BIGINT, cookie_id STRING",
    "site_events": "visit_id STRING, cookie_id STRING, page_id INT, event_type INT,"
    " event_time TIMESTAMP_NTZ",
    "page_hierarchy": "page_id INT, page_name STRING, product_category STRING, product_id INT",
    "event_identifier": "event_type INT, event_name STRING",
    "campaign_identifier": "campaign_name STRING, start_date TIMESTAMP_NTZ, end_date TIMESTAMP_NTZ",
    "interest_metrics": "month_year STRING, interest_id STRING, composition DECIMAL(18,2),"
    " index_value DECIMAL(18,4), ranking INT, percentile_ranking DECIMAL(18,2)",
    "interest_map": "id BIGINT, interest_name STRING, interest_summary STRING, created_at DATE,"
    " last_modified DATE",
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One stored parquet table with its declared schema."""
    return spark.read.schema(STORED[name]).parquet(f"{folder}/{name}.parquet")


def declared(df: DataFrame, name: str) -> DataFrame:
    """The job input, if its columns and types are the declared ones."""
    found = [(f.name, f.dataType) for f in df.schema]
    wanted = [(f.name, f.dataType) for f in T.StructType.fromDDL(INPUTS[name])]
    if found != wanted:
        raise TypeError(f"{name}: {found} is not {wanted}")
    return df


def inline_table(spark: SparkSession, name: str, rows: list[tuple]) -> DataFrame:
    """Literal rows cast to the declared schema of a job input."""
    return spark.createDataFrame(rows, INPUTS[name])
