"""Row-level comparison of two tables that mostly agree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Buckets that a table is compared by; their digests are one small row each.
BUCKETS = 4096


def row_changes(old: DataFrame, new: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(keys, change): the keys that were added, removed or changed from old to new; NULL equals NULL.

    Buckets of keys are compared by digests of their rows first, and only rows of buckets that differ are joined, by
    key and a digest of the row: equal tables shuffle digests only. Keys are unique in each table.
    """
    columns = [c for c in old.columns if c not in keys]

    def digested(df: DataFrame) -> DataFrame:
        row = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("_bucket")
        return df.select(F.struct(*keys).alias("_key"), row.alias("_row"), bucket)

    def by_bucket(rows: DataFrame, name: str) -> DataFrame:
        place = F.xxhash64("_key", "_row").cast("decimal(38,0)")
        return rows.groupBy("_bucket").agg(F.struct(F.count(F.lit(1)), F.sum(place)).alias(name))

    a, b = digested(old), digested(new)
    sums = by_bucket(a, "_a").join(by_bucket(b, "_b"), "_bucket", "full")
    differ = sums.where(~F.col("_a").eqNullSafe(F.col("_b"))).select("_bucket")
    left = a.join(differ, "_bucket", "left_semi").select("_key", F.col("_row").alias("_old"))
    right = b.join(differ, "_bucket", "left_semi").select("_key", F.col("_row").alias("_new"))
    met = left.join(right, "_key", "full").where(~F.col("_old").eqNullSafe(F.col("_new")))
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").otherwise("changed")
    return met.select("_key.*", change.alias("change"))
