"""Writing results: replace, append, appends that may be retried, changes of single partitions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _rename(spark: SparkSession, path: str, to: str) -> None:
    folder, files = _files(spark, path)
    if not files.rename(folder, _files(spark, to)[0]):
        raise OSError(f"{path} was not renamed to {to}")


def save_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Replace a parquet table, or make it, and return its path.

    The rows are written beside the table, to `path.new`, which takes its place once they are whole. A run that dies
    while it writes leaves the old table; one that dies between the two renames leaves it in `path.old`, from where
    the next run takes it back. With partition columns the rows are first gathered by them, in pieces of
    bounded size, so a large partition is written by several tasks.
    """
    spark, new, old = df.sparkSession, f"{path}.new", f"{path}.old"
    (folder, files), (former, _) = _files(spark, path), _files(spark, old)
    if files.exists(former) and not files.exists(folder):
        _rename(spark, old, path)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(new)
    files.delete(former, True)
    if files.exists(folder):
        _rename(spark, path, old)
    _rename(spark, new, path)
    files.delete(former, True)
    return path


def append_table(df: DataFrame, path: str, columns: list[str]) -> str:
    """Append a result to a stored table, columns by position."""
    df.toDF(*columns).write.mode("append").parquet(path)
    return path


def _replace_partitions(df: DataFrame, path: str, column: str) -> None:
    """Write the rows beside the table and put them in place of their partitions once all are written."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(column).parquet(path)


def append_batch(df: DataFrame, path: str, batch: str) -> str:
    """Append a batch to a stored table that keeps each batch in a partition `batch_id` of its own.

    A batch that is written again takes its own place, so a retried append doubles nothing, and a run that dies
    leaves the table as it was.
    """
    _replace_partitions(df.withColumn("batch_id", F.lit(batch)), path, "batch_id")
    return path


def change_partitions(
    spark: SparkSession, path: str, column: str, values: list, change: Callable[[DataFrame], DataFrame]
) -> str:
    """UPDATE or DELETE in a stored table: the rows of the given partitions become `change` of them.

    Other partitions keep their files. A run that dies while it writes leaves the table as it was. `change` keeps
    each row in its partition; a partition that it leaves empty is taken away last.
    """
    table = spark.read.parquet(path)
    changed = change(table.where(F.col(column).isin(values))).select(*table.columns)
    left = {r[0] for r in changed.select(column).distinct().collect()}
    if not left <= set(values):
        raise ValueError(f"rows move to partitions {sorted(left - set(values))}")
    _replace_partitions(changed, path, column)
    for value in set(values) - left:
        folder, files = _files(spark, f"{path}/{column}={value}")
        files.delete(folder, True)
    return path


def append_rows(df: DataFrame, rows: list[tuple]) -> DataFrame:
    """The table with literal rows added, columns by position."""
    return df.union(literal_rows(df, rows))


def literal_rows(df: DataFrame, rows: list[tuple]) -> DataFrame:
    """Rows as literals with the columns and types of the table; a relation Spark knows the size of."""
    spark, fields = df.sparkSession, df.schema.fields
    cells = [
        F.array(
            *[
                F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)])
                for row in rows
            ]
        ).alias("row")
    ]
    return spark.sql("SELECT 1").select(*cells).select(F.inline("row"))
