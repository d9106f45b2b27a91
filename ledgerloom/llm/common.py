"""What several operators share: the shared folder, stored tables, row ids, connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a missing id, sorts before every other id.
NO_ID = -(2**63)
#: A word is a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local session without one gets a temp folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = f"file://{tempfile.gettempdir()}/ledgerloom-shared"
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read back: cuts lineage, survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a table made by `stored` once nothing reads it any more."""
    spark = df.sparkSession
    base = shared_folder(spark).removeprefix("file://")
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        if base in folder and folder.rpartition("/")[2].startswith("llm-"):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bound(value: Column, body) -> Column:
    """`body(value)` with the value worked out once per row, also inside of higher-order functions."""
    return F.element_at(F.transform(F.array(value), body), 1)


def row_id(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node reachable, for every node with a link to another node.

    Alternates two steps until nothing changes: hang each larger neighbour on the smallest one, then
    hang smaller neighbours on the smallest one. Each step is one aggregate and one join on the node,
    so a node with very many links is pre-aggregated and its join partition can be split. Rounds grow
    with the logarithm of the longest chain. Every round is stored in the shared folder.
    """
    edges = stored(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .distinct()
    )
    before = None
    while True:
        lowest = edges.groupBy(F.col("hi").alias("lo")).agg(F.min("lo").alias("m"))
        hung = edges.join(lowest, "lo", "left").select("hi", F.coalesce("m", "lo").alias("lo"))
        lowest = hung.groupBy("hi").agg(F.min("lo").alias("m"))
        rest = hung.join(lowest, "hi").where(F.col("lo") > F.col("m"))
        step = stored(
            rest.select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .union(lowest.select("hi", F.col("m").alias("lo")))
            .distinct()
        )
        now = step.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first()
        dropped(edges)
        edges = step
        if now == before:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
                edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
            )
        before = now
