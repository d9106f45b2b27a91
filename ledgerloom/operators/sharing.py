"""Helps two branches of a plan read one shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def read_alike(df: DataFrame) -> DataFrame:
    """The same rows. Spark prunes no column below, so all readers of it share their shuffles.

    The test looks at every column and is true for every row.
    """
    return df.filter(F.xxhash64(*df.columns).bitwiseOR(F.lit(1)) != 0)
