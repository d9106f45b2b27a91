"""Stored tables after runs that die half-way and runs that are repeated."""

from __future__ import annotations

import pytest
from conftest import sorted_rows
from pyspark.sql import functions as F

from ledgerloom.sources.sinks import append_batch, change_partitions, save_table

DIES = F.raise_error


def files(folder):
    return sorted(str(f.relative_to(folder)) for f in folder.rglob("*.parquet"))


@pytest.fixture
def table(spark, tmp_path):
    rows = [(i, i % 4, f"v{i}") for i in range(100)]
    spark.createDataFrame(rows, "id int, part int, v string").write.partitionBy("part").parquet(str(tmp_path / "t"))
    return tmp_path / "t"


def stored(spark, folder):
    return sorted_rows(spark.read.parquet(str(folder)).select("id", "v", "part"))


def test_an_update_touches_its_partitions_only(spark, table):
    before, kept = files(table), [f for f in files(table) if "part=1" not in f]
    change_partitions(spark, str(table), "part", [1], lambda df: df.withColumn("v", F.upper("v")))
    assert [f for f in files(table) if "part=1" not in f] == kept and files(table) != before
    assert stored(spark, table) == sorted([(i, f"V{i}" if i % 4 == 1 else f"v{i}", i % 4) for i in range(100)], key=repr)


def test_a_delete_may_empty_a_partition(spark, table):
    for _ in range(2):
        change_partitions(spark, str(table), "part", [2, 3], lambda df: df.where("part = 3 AND id > 50"))
        assert stored(spark, table) == sorted([(i, f"v{i}", i % 4) for i in range(100) if i % 4 < 2 or i % 4 == 3 and i > 50], key=repr)


def test_a_run_that_dies_leaves_the_old_table(spark, table):
    before, old = files(table), stored(spark, table)

    def change(df):
        return df.repartition(8).withColumn("v", F.when(F.col("id") == 61, DIES(F.lit("dies"))).otherwise(F.upper("v")))

    with pytest.raises(Exception, match="dies"):
        change_partitions(spark, str(table), "part", [0, 1], change)
    assert files(table) == before and stored(spark, table) == old


def test_rows_stay_in_their_partition(spark, table):
    with pytest.raises(ValueError, match="move"):
        change_partitions(spark, str(table), "part", [1], lambda df: df.withColumn("part", F.lit(2)))


def test_a_batch_may_be_retried(spark, tmp_path):
    path = str(tmp_path / "ratings")
    first = spark.createDataFrame([(i, i % 5) for i in range(50)], "order_id int, rating int").repartition(4)
    append_batch(first, path, "monday")
    broken = first.withColumn("rating", F.when(F.col("order_id") == 33, DIES(F.lit("dies"))).otherwise(9))
    with pytest.raises(Exception, match="dies"):
        append_batch(broken, path, "tuesday")
    assert spark.read.parquet(path).count() == 50
    for _ in range(2):
        append_batch(first, path, "tuesday")
        append_batch(first, path, "monday")
    found = spark.read.parquet(path)
    assert sorted_rows(found) == sorted([(i, i % 5, b) for i in range(50) for b in ("monday", "tuesday")], key=repr)


@pytest.mark.parametrize("by", [None, ["part"]])
def test_a_table_is_replaced_when_the_new_one_is_whole(spark, tmp_path, by):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(i, f"v{i}", i % 4) for i in range(100)], "id int, v string, part int")
    save_table(first, path, by)
    old, before = stored(spark, tmp_path / "t"), files(tmp_path / "t")
    broken = first.repartition(8).withColumn("v", F.when(F.col("id") == 61, DIES(F.lit("dies"))).otherwise("new"))
    with pytest.raises(Exception, match="dies"):
        save_table(broken, path, by)
    assert stored(spark, tmp_path / "t") == old and files(tmp_path / "t") == before
    # the new table may be made from the old one
    for n in (2, 3):
        save_table(spark.read.parquet(path).withColumn("v", F.concat("v", F.lit("+"))), path, by)
        assert {r[1].count("+") for r in stored(spark, tmp_path / "t")} == {n - 1}
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_a_run_that_dies_between_the_renames(spark, tmp_path):
    path = tmp_path / "t"
    save_table(spark.createDataFrame([(1, "a", 0)], "id int, v string, part int"), str(path))
    path.rename(tmp_path / "t.old")
    broken = spark.createDataFrame([(2, "b", 0)], "id int, v string, part int").withColumn("v", DIES(F.lit("dies")))
    with pytest.raises(Exception, match="dies"):
        save_table(broken, str(path))
    assert stored(spark, path) == [(1, "a", 0)]
    save_table(spark.createDataFrame([(3, "c", 0)], "id int, v string, part int"), str(path))
    assert stored(spark, path) == [(3, "c", 0)] and [p.name for p in tmp_path.iterdir()] == ["t"]
