"""Weekly retail sales: cleaning, shares, before and after a pivot week.

Input of the first job: weekly_sales as declared in sources.tables. All others read
the cleaned table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import short_date, us_week
from ..functions.numbers import int_div, percent, ratio
from ..operators.compare import before_after, change_percent, share_of_total
from ..operators.topn import top_n

DIMENSIONS = ["region", "platform", "age_band", "demographic", "customer_type"]
PLATFORMS = ["Retail", "Shopify"]


def clean_weekly_sales(weekly_sales: DataFrame) -> DataFrame:
    segment = F.col("segment")
    age_band = (
        F.when(segment.isin("C1", "F1"), "Young Adults")
        .when(segment.isin("C2", "F2"), "Middle Aged")
        .when(segment.isin("C3", "F3", "C4"), "Retirees")
        .otherwise("unknown")
    )
    demographic = (
        F.when(segment.startswith("C"), "Couples")
        .when(segment.startswith("F"), "Families")
        .otherwise("unknown")
    )
    dated = weekly_sales.withColumn("week_d", short_date(F.col("week_date")))
    return dated.select(
        "week_d",
        us_week(F.col("week_d")).alias("week_number"),
        F.month("week_d").alias("month_number"),
        F.year("week_d").alias("calendar_year"),
        "segment",
        age_band.alias("age_band"),
        demographic.alias("demographic"),
        percent(F.col("sales"), F.col("transactions")).alias("avg_transaction"),
        "transactions",
        F.col("sales").cast("bigint").alias("sales"),
        "region",
        "platform",
        "customer_type",
    )


def weekday_names(clean: DataFrame) -> DataFrame:
    days = clean.select("week_d").distinct()
    return days.select(F.date_format("week_d", "EEEE").alias("day_name")).distinct()


def week_numbers_present(clean: DataFrame) -> DataFrame:
    return clean.select("week_number").distinct().orderBy("week_number")


def missing_weeks(clean: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Weeks 1 to 53 that have no row, in all or in each group that has rows."""
    key = [*by, "week_number"]
    present = clean.select(*key).distinct()
    if not by:
        weeks = clean.sparkSession.range(1, 54).select(F.col("id").cast("int").alias("week_number"))
    else:
        year = F.sequence(F.lit(1), F.lit(53))
        weeks = present.select(*by).distinct().withColumn("week_number", F.explode(year))
    return weeks.join(present, key, "left_anti").orderBy(*key)


def tx_by_year(clean: DataFrame) -> DataFrame:
    return clean.groupBy("calendar_year").agg(F.sum("transactions").alias("count_trans"))


def sales_region_month(clean: DataFrame) -> DataFrame:
    total = F.sum("sales").alias("sales_per_region_month")
    return clean.groupBy("region", "month_number").agg(total)


def tx_by_platform(clean: DataFrame) -> DataFrame:
    return clean.groupBy("platform").agg(F.sum("transactions").alias("count_trans"))


def _platform_share(clean: DataFrame, group: list[str]) -> DataFrame:
    shares = {f"{p.lower()}_p": F.col("platform") == p for p in PLATFORMS}
    return share_of_total(clean, group, "sales", shares)


def platform_share_month(clean: DataFrame) -> DataFrame:
    return _platform_share(clean, ["calendar_year", "month_number"])


def platform_share_region(clean: DataFrame, dim: str = "region") -> DataFrame:
    """As written by region; `dim='demographic'` gives what is asked for."""
    return _platform_share(clean, ["calendar_year", dim])


def retail_share_by_segment(clean: DataFrame) -> DataFrame:
    """Whole percent of retail sales per age band and demographic, fraction dropped.

    The total is that of the groups, of which there are a handful.
    """
    retail = clean.filter(F.col("platform") == "Retail")
    sums = retail.groupBy("age_band", "demographic").agg(F.sum("sales").alias("s"))
    share = int_div(F.lit(100) * F.col("s"), F.sum("s").over(Window.partitionBy()))
    return sums.select("age_band", "demographic", share.alias("retail_sales_percentage"))


def avg_transaction_compare(clean: DataFrame) -> DataFrame:
    """Truncated sales per transaction beside the (misleading) average of averages."""
    average = ratio(F.sum("avg_transaction"), F.count("avg_transaction"), 2)
    return (
        clean.groupBy("calendar_year", "platform")
        .agg(
            int_div(F.sum("sales"), F.sum("transactions")).alias("correct_avg"),
            average.alias("incorrect_avg"),
        )
        .orderBy("calendar_year", "platform")
    )


# Before and after


def _around(clean: DataFrame, pivot: str, weeks: int, same_year: bool) -> DataFrame:
    """One row with the sums of the weeks before and after; no row if the pivot week has none."""
    day = F.lit(pivot).cast("date")
    week, pivot_week = F.col("week_number"), us_week(day)
    scope = F.col("calendar_year") == F.year(day) if same_year else F.lit(True)
    before = scope & week.between(pivot_week - weeks, pivot_week - 1)
    after = scope & week.between(pivot_week, pivot_week + weeks - 1)
    tagged = clean.withColumn("_at", F.col("week_d") == day)
    sums = tagged.agg(
        F.sum(F.when(before, F.col("sales"))).alias("before"),
        F.sum(F.when(after, F.col("sales"))).alias("after"),
        F.count_if("_at").alias("_pivot_rows"),
    )
    return sums.filter((F.col("_pivot_rows") > 0) & F.col("before").isNotNull())


def before_after_4w(clean: DataFrame, pivot: str, same_year: bool = False) -> DataFrame:
    """Change and ratio over four weeks, all years together as written."""
    sums = _around(clean, pivot, 4, same_year)
    return sums.select(
        (F.col("after") - F.col("before")).alias("reduction_v"),
        ratio(F.col("after"), F.col("before"), 2).alias("reduction_p"),
    )


def before_after_12w(clean: DataFrame, pivot: str, same_year: bool = False) -> DataFrame:
    sums = _around(clean, pivot, 12, same_year)
    return sums.select(
        F.lit("After").alias("time"),
        F.col("after").alias("sales"),
        F.col("before").alias("sales_n"),
    )


def before_after_vs_years(clean: DataFrame, pivot: str, years: tuple[int, ...]) -> DataFrame:
    """Twelve-week sums over the full sums of the given years, from one pass."""
    pivot_week = us_week(F.lit(pivot).cast("date"))
    week, sales = F.col("week_number"), F.col("sales")
    before = week.between(pivot_week - 12, pivot_week - 1)
    after = week.between(pivot_week, pivot_week + 11)
    sums = clean.agg(
        F.sum(F.when(before, sales)).alias("before"),
        F.sum(F.when(after, sales)).alias("after"),
        F.count_if(F.col("week_d") == F.lit(pivot).cast("date")).alias("_pivot_rows"),
        *[F.sum(F.when(F.col("calendar_year") == y, sales)).alias(f"y{y}") for y in years],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(str(y)).alias("Year"),
                ratio(F.col("after"), F.col(f"y{y}"), 5).alias("Custom_After"),
                ratio(F.col("before"), F.col(f"y{y}"), 5).alias("Custom_Before"),
            )
            for y in years
        ]
    )
    found = sums.filter((F.col("_pivot_rows") > 0) & F.col("before").isNotNull())
    return found.select(F.inline(rows))


def _periods(same_year: int | None) -> tuple[Column, Column]:
    scope = F.lit(True) if same_year is None else F.col("calendar_year") == same_year
    week = F.col("week_number")
    return scope & week.between(13, 24), scope & week.between(25, 36)


def impact(clean: DataFrame, dim: str, same_year: int | None = None) -> DataFrame:
    """The value of `dim` with the lowest change from weeks 13-24 to weeks 25-36."""
    sums = before_after(clean, [dim], "sales", *_periods(same_year))
    changes = sums.select(F.col(dim).alias("area"), change_percent().alias("percentage"))
    return top_n(changes, "percentage", 1, ["area"], ascending=True)


def worst_area_union(clean: DataFrame, same_year: int | None = None) -> DataFrame:
    """The lowest change of each dimension, sorted.

    The sums are taken once for all dimensions together; that result is small
    (one row per combination) and feeds the five rankings.
    """
    cube = before_after(clean, DIMENSIONS, "sales", *_periods(same_year))
    cells = F.array(
        *[F.struct(F.lit(d).alias("dim"), F.col(d).alias("area")) for d in DIMENSIONS]
    )
    per_area = (
        cube.select("before", "after", F.inline(cells))
        .groupBy("dim", "area")
        .agg(F.sum("before").alias("before"), F.sum("after").alias("after"))
        .select("dim", "area", change_percent().alias("percentage"))
    )
    lowest = [
        top_n(per_area.filter(F.col("dim") == d), "percentage", 1, ["area"], ascending=True)
        for d in DIMENSIONS
    ]
    union = reduce(DataFrame.unionByName, lowest)
    return union.select("area", "percentage").orderBy("percentage", "area")
