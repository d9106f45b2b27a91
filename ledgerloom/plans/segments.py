"""Interest segments: cleaning, coverage, composition and index analysis.

Inputs: interest_metrics(month_year, interest_id, composition, index_value, ranking,
percentile_ranking) with one row per interest and month, interest_map(id,
interest_name, ...). Jobs after the first read
the metrics with dated months. Interest ids are text in the metrics and numbers in
the map, so the join casts them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import month_start
from ..functions.numbers import cut_ratio, decimal_avg, ratio
from ..operators.coverage import coverage, cumulative_share, reconcile_keys, rolling_avg
from ..operators.sharing import read_alike
from ..operators.topn import top_n, top_n_with_ties

MAP_COLUMNS = ["interest_name", "interest_summary", "created_at", "last_modified"]


def _named(metrics: DataFrame, interest_map: DataFrame, how: str = "inner") -> DataFrame:
    return metrics.join(
        interest_map, F.col("interest_id").try_cast("bigint") == F.col("id"), how
    )


def month_year_to_date(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("month_year", month_start(F.col("month_year")))


def records_by_month(metrics: DataFrame, order: str = "as_written") -> DataFrame:
    """Records per month; as written newest first, `order='oldest'` puts NULL, then oldest."""
    counts = metrics.groupBy("month_year").agg(F.count(F.lit(1)).alias("n"))
    if order == "oldest":
        return counts.orderBy(F.asc_nulls_first("month_year"))
    placed = F.coalesce("month_year", F.lit("2020-01-01").cast("date"))
    return counts.orderBy(placed.desc())


def null_month_count(metrics: DataFrame) -> DataFrame:
    return metrics.filter(F.col("month_year").isNull()).agg(F.count(F.lit(1)).alias("null_c"))


def drop_null_months(metrics: DataFrame) -> DataFrame:
    return metrics.filter(F.col("month_year").isNotNull())


def reconcile_ids(metrics: DataFrame, interest_map: DataFrame) -> DataFrame:
    ids = metrics.select(F.col("interest_id").try_cast("bigint").alias("interest_id"))
    missing = reconcile_keys(interest_map, ids, "id", "interest_id")
    flags = {"total_not_in_map": "left_key", "total_not_in_metric": "right_key"}
    return missing.agg(
        *[F.sum(F.when(F.col(k).isNull(), 1).otherwise(0)).alias(n) for n, k in flags.items()]
    )


def map_count(interest_map: DataFrame) -> DataFrame:
    return interest_map.agg(F.count("id").alias("id_counts"))


def joined_interest(
    metrics: DataFrame, interest_map: DataFrame, interest_id: str | None = None
) -> DataFrame:
    """Metrics with the map's columns; `interest_id` keeps one interest."""
    if interest_id is not None:
        metrics = metrics.filter(F.col("interest_id") == interest_id)
    return _named(metrics, interest_map, "left").select(*metrics.columns, *MAP_COLUMNS)


def month_before_created(metrics: DataFrame, interest_map: DataFrame) -> DataFrame:
    joined = joined_interest(metrics, interest_map)
    return joined.filter(F.col("month_year") < F.col("created_at"))


# Coverage


def always_present(metrics: DataFrame) -> DataFrame:
    months = metrics.agg(F.count_distinct("month_year").alias("n")).scalar()
    present = coverage(metrics, "interest_id", "month_year")
    return present.filter(F.col("total_month") == months).agg(
        F.count(F.lit(1)).alias("tota_interests")
    )


def cumulative_pct(metrics: DataFrame, at_least: int = 90) -> DataFrame:
    months = coverage(metrics, "interest_id", "month_year")
    counts = months.groupBy("total_month").agg(F.count(F.lit(1)).alias("total_id"))
    shares = cumulative_share(counts, "total_month", "total_id", "c_perc")
    return shares.filter(F.col("c_perc") >= at_least)


def rows_below_threshold(metrics: DataFrame, months: int) -> DataFrame:
    """Rows of the interests with too few months, summed from their counts: no join back."""
    counts = metrics.groupBy("interest_id").agg(
        F.count_distinct("month_year").alias("total_months"), F.count(F.lit(1)).alias("n")
    )
    thin = F.col("interest_id").isNotNull() & (F.col("total_months") < months)
    removed = F.coalesce(F.sum("n"), F.lit(0)).alias("rm_rows")
    return counts.filter(thin).agg(removed)


def interests_per_month(metrics: DataFrame, more_than: int) -> DataFrame:
    """Rows per month of interests with more than so many rows (not distinct months).

    An interest has one row per month, so its window is short and saves a second pass.
    """
    own = F.count("interest_id").over(Window.partitionBy("interest_id"))
    wide = metrics.withColumn("_rows", own).filter(F.col("_rows") > more_than)
    counts = drop_null_months(wide).groupBy("month_year").agg(
        F.count("interest_id").alias("number_of_interests")
    )
    return counts.orderBy("month_year")


def filtered_metrics(metrics: DataFrame, months: int) -> DataFrame:
    """Rows of the interests with enough distinct months.

    An interest has one row per month, so its window is short and saves a second pass.
    """
    present = F.collect_set("month_year").over(Window.partitionBy("interest_id"))
    counted = metrics.withColumn("_months", F.size(present))
    wide = F.col("interest_id").isNotNull() & (F.col("_months") >= months)
    return counted.filter(wide).drop("_months")


# Segments, on the filtered metrics


def extreme_composition(
    filtered: DataFrame,
    interest_map: DataFrame,
    lowest: bool = False,
    per_interest: bool = False,
    n: int = 10,
) -> DataFrame:
    """Rows with composition rank 1 to n from the top or the bottom, ties kept.

    As written all rows are ranked; `per_interest` ranks each interest's highest row.
    """
    named = _named(filtered, interest_map).select(
        "month_year", "interest_id", "interest_name", "composition"
    )
    if per_interest:
        peak = F.min(F.struct((-F.col("composition")).alias("c"), "month_year")).alias("peak")
        named = named.groupBy("interest_id", "interest_name").agg(peak).select(
            F.col("peak.month_year").alias("month_year"),
            "interest_id", "interest_name",
            (-F.col("peak.c")).alias("composition"),
        )
    return top_n_with_ties(named, "composition", n, ascending=lowest)


def worst_ranking5(filtered: DataFrame, interest_map: DataFrame) -> DataFrame:
    average = decimal_avg(F.col("ranking"), 2).alias("avg_r")
    ranks = _named(filtered, interest_map).groupBy("interest_name").agg(average)
    return top_n(ranks, "avg_r", 5, ["interest_name"])


def _five_most_variable(named: DataFrame) -> DataFrame:
    """Five interests with the highest sample deviation of the percentile ranking, and its ends.

    Variance from exact decimal sums, so the result does not depend on row order.
    """
    x = F.col("percentile_ranking").cast("decimal(10,2)")
    sums = named.groupBy("interest_name").agg(
        F.count(x).alias("n"), F.sum(x).alias("s"), F.sum(x * x).alias("q"),
        F.min("percentile_ranking").alias("lo"), F.max("percentile_ranking").alias("hi"),
    )
    spread = F.col("q") * F.col("n") - F.col("s") * F.col("s")
    degrees = F.nullif(F.col("n") * (F.col("n") - 1), F.lit(0))
    deviation = F.sqrt(spread.cast("double") / degrees.cast("double"))
    rounded = F.round(deviation, 2).cast("decimal(10,2)").alias("avg_r")
    return top_n(sums.select("interest_name", rounded, "lo", "hi"), "avg_r", 5, ["interest_name"])


def most_variable5(filtered: DataFrame, interest_map: DataFrame) -> DataFrame:
    five = _five_most_variable(_named(filtered, interest_map))
    return five.select("interest_name", "avg_r")


def percentile_extremes(
    filtered: DataFrame,
    interest_map: DataFrame,
    per_interest: bool = False,
    five_only: bool = True,
) -> DataFrame:
    """Rows with the lowest or highest percentile ranking of the five most variable interests.

    The extremes are those over all five together; `per_interest` takes each
    interest's own, `five_only=False` looks at all interests.
    """
    named = _named(filtered, interest_map)
    value = F.col("percentile_ranking")
    if five_only:
        # Five rows at most: broadcast, and looked at as a whole.
        everyone = Window.partitionBy()
        five = _five_most_variable(named).select(
            "interest_name",
            F.min("lo").over(everyone).alias("lo"),
            F.max("hi").over(everyone).alias("hi"),
        )
        named = named.join(F.broadcast(five), "interest_name")
    if per_interest:
        own = Window.partitionBy("interest_id")
        named = named.withColumns({"lo": F.min(value).over(own), "hi": F.max(value).over(own)})
    if five_only or per_interest:
        kept = named.filter((value == F.col("lo")) | (value == F.col("hi")))
    else:
        # The ends are taken from the very rows that are filtered by them.
        named = read_alike(named)
        end = named.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
        kept = named.filter((value == end["lo"]) | (value == end["hi"]))
    return kept.orderBy("interest_id", "percentile_ranking").select(
        "month_year", "interest_name", "percentile_ranking"
    )


# Index


def _avg_comp() -> Column:
    # The index has four digits: shift both sides so that two remain.
    return ratio(F.col("composition") * 100, F.col("index_value") * 100, 2)


def monthly_top10(metrics: DataFrame, interest_map: DataFrame, n: int = 10) -> DataFrame:
    """The n interests with the highest average composition of each month.

    The rank filter is pushed below the shuffle, so each task sends n rows per month.
    """
    order = Window.partitionBy("month_year").orderBy(F.desc("avg_comp"), "interest_id")
    ranked = metrics.select("interest_id", "month_year", _avg_comp().alias("avg_comp")).withColumn(
        "rn", F.row_number().over(order)
    )
    return _named(ranked.filter(F.col("rn") <= n), interest_map).select(
        "interest_id", "interest_name", "month_year", "avg_comp", "rn"
    )


def most_frequent_top10(metrics: DataFrame, interest_map: DataFrame) -> DataFrame:
    top = monthly_top10(metrics, interest_map)
    counts = top.groupBy("interest_name").agg(F.count(F.lit(1)).alias("most_appeared"))
    return top_n(counts, "most_appeared", 1, ["interest_name"])


def avg_of_avg_comp(metrics: DataFrame, interest_map: DataFrame) -> DataFrame:
    top = monthly_top10(metrics, interest_map)
    return top.groupBy("month_year").agg(
        cut_ratio(F.sum("avg_comp"), F.count("avg_comp")).alias("avg_of_avg_comp")
    )


def rolling3_with_leaders(metrics: DataFrame, interest_map: DataFrame, after: str) -> DataFrame:
    """Each month's leader with the 3-month average and the two leaders before it."""
    months = Window.orderBy("month_year")
    leaders = monthly_top10(metrics, interest_map, n=1)

    def earlier(back: int) -> Column:
        name = F.coalesce(F.lag("interest_name", back).over(months), F.lit(""))
        value = F.coalesce(F.lag("avg_comp", back).over(months).cast("string"), F.lit(""))
        return F.concat(name, F.lit(" : "), value)

    average = F.round(rolling_avg(F.col("avg_comp"), "month_year", 3), 2).cast("decimal(18,2)")
    rows = leaders.select(
        "month_year",
        "interest_name",
        F.col("avg_comp").alias("max_index_composition"),
        average.alias("3_month_moving_avg"),
        earlier(1).alias("1_month_ago"),
        earlier(2).alias("2_month_ago"),
    )
    return rows.filter(F.col("month_year") > F.lit(after).cast("date"))
