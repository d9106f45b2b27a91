"""Mixing sources to target weights.

A source's share of all tokens is raised to an exponent and normalised to its weight. The exponent is bisected
between 0 (all sources alike) and 1 (shares as they are): to the smallest one that keeps every source within a
repetition limit, or to the one whose weights have a target entropy. With no budget given, the budget is
the least one in which every document appears.

A source's budget is spent in passes. Each pass is a permutation of the source in blocks: a document's place in
a pass is a hash of its id and the pass, and the leading part of the place is its block. Whole passes take
all documents. The last pass takes documents while the tokens before them in its permutation are below
what is left. Block sums, added up per source, find the one block where the budget ends; only that block's rows
are ordered, which gives the place where the source is cut. So each document knows from its own row how
often it appears: texts are never shuffled, and a source of any size is spread over all tasks.

Sources are few by nature: one row of each comes to the driver, nothing else does.

Defined cases: a null source is a source of its own; null or blank texts have no tokens and appear with their
source; a source without tokens appears once; an empty table gives an empty table; rows with equal id share
their place; a null id counts as zero. All other columns pass through `mix`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import WORD, stored

#: Documents of a source may appear this often at most.
REPEATS = 2.0
BLOCK = 4096
SEED = 17


def n_tokens(text: Column) -> Column:
    """Words of a text: ends of runs without white space."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def weights(tokens: dict, exponent: float) -> dict:
    """Normalised shares to the power of the exponent, for sources with tokens."""
    total = sum(tokens.values())
    raised = {k: (n / total) ** exponent for k, n in tokens.items() if n > 0}
    return {k: x / sum(raised.values()) for k, x in raised.items()}


def entropy(shares: dict) -> float:
    return -sum(p * math.log(p) for p in shares.values() if p > 0)


def passes(tokens: dict, exponent: float, budget: float | None) -> dict:
    """How often each source appears; without a budget the rarest appears once."""
    shares = weights(tokens, exponent)
    if not shares:
        return {}
    if budget is None:
        budget = max(tokens[k] / p for k, p in shares.items())
    return {k: budget * p / tokens[k] for k, p in shares.items()}


def exponent_for(
    tokens: dict,
    repeats: float | None = REPEATS,
    target_entropy: float | None = None,
    budget: float | None = None,
    rounds: int = 60,
) -> float:
    """The exponent in [0, 1] by bisection: least one within the repetition limit, or of the target entropy."""

    def fits(exponent: float) -> bool:
        if target_entropy is not None:
            return entropy(weights(tokens, exponent)) <= target_entropy
        return max(passes(tokens, exponent, budget).values(), default=0) <= repeats

    low, high = 0.0, 1.0
    if fits(low):
        return low
    for _ in range(rounds):
        middle = (low + high) / 2
        low, high = (low, middle) if fits(middle) else (middle, high)
    return high


def place(id_: Column, pass_: Column) -> Column:
    """A document's place in the permutation of a pass, in [0, 2^62)."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.coalesce(id_, F.lit(0)), pass_), 2)


def block_of(place_: Column, blocks: Column) -> Column:
    return F.floor(place_ / F.ceil(F.lit(float(2**62)) / blocks)).cast("long")


SOURCE_PLAN = "_source string, _weight double, _whole int, _left double, _blocks long"


def source_plan(slim: DataFrame, repeats, target_entropy, budget) -> DataFrame:
    """A row per source: weight, whole passes, tokens of the last pass, and the place where that one ends."""
    rows = slim.groupBy("_source").agg(F.sum("_tokens").alias("n"), F.count("*").alias("docs")).collect()
    tokens = {r["_source"]: r["n"] for r in rows}
    exponent = exponent_for(tokens, repeats, target_entropy, budget)
    shares, times = weights(tokens, exponent), passes(tokens, exponent, budget)
    plans = []
    for r in rows:
        time = times.get(r["_source"], 1.0)
        whole = int(time + 1e-9)
        left = (time - whole) * r["n"] if time - whole > 1e-9 else 0.0
        plans.append(
            (r["_source"], shares.get(r["_source"], 0.0), whole, left, max(1, -(-r["docs"] // BLOCK)))
        )
    spark = slim.sparkSession
    plan = spark.createDataFrame(plans, SOURCE_PLAN)
    at = with_plan(slim, plan).where("_left > 0")
    at = at.withColumn("_place", place(F.col("_id"), F.col("_whole") + 1))
    at = at.withColumn("_block", block_of(F.col("_place"), F.col("_blocks")))
    sums = at.groupBy("_source", "_left", "_block").agg(F.sum("_tokens").alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(_before("_block", "_source")), F.lit(0))
    ends = (
        sums.withColumn("_before", before)
        .where("_before < _left AND _before + _sum >= _left")
        .groupBy("_source")
        .agg(F.min_by(F.struct("_block", "_before"), "_block").alias("_end"))
    )
    ends = spark.createDataFrame(
        [(r["_source"], r["_end"]["_block"], r["_end"]["_before"]) for r in ends.collect()],
        "_s string, _end long, _start long",
    )
    border = at.join(ends, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_block") == F.col("_end")))
    spent = F.col("_start") + F.coalesce(F.sum("_tokens").over(_before("_place", "_source")), F.lit(0))
    cuts = border.withColumn("_spent", spent).where("_spent >= _left")
    cuts = {r["_source"]: r["_cut"] for r in cuts.groupBy("_source").agg(F.min("_place").alias("_cut")).collect()}
    ended = {r["_s"]: (r["_end"], blocks) for r in ends.collect() for s, _, _, _, blocks in plans if s == r["_s"]}
    final = []
    for source, weight, whole, left, blocks in plans:
        cut = 0
        if left > 0:
            cut = cuts.get(source)
            if cut is None and source in ended:  # the budget ends with the block's last row
                cut = min(2**62, (ended[source][0] + 1) * math.ceil(2.0**62 / blocks))
            cut = 2**62 if cut is None else cut
        final.append((source, weight, whole, cut))
    return spark.createDataFrame(final, "_source string, _weight double, _whole int, _cut long")


def _before(order: str, source: str):
    return Window.partitionBy(source).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows with their source's plan; Spark sends the small plan to every task."""
    names = {c: f"{c}_of" if c == "_source" else c for c in plan.columns}
    other = plan.select(*[F.col(c).alias(n) for c, n in names.items()])
    return rows.join(other, F.col("_source").eqNullSafe(F.col("_source_of"))).drop("_source_of")


def appearances(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """A row per appearance: _pass from 1 and _place, the position in that pass."""
    at = with_plan(rows, plan)
    more = place(F.col("_id"), F.col("_whole") + 1) < F.col("_cut")
    times = F.col("_whole") + more.cast("int")
    at = at.where(times > 0).withColumn("_pass", F.explode(F.sequence(F.lit(1), times)))
    return at.withColumn("_place", place(F.col("_id"), F.col("_pass")))


def slim_rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("_id"),
        F.col("source").cast("string").alias("_source"),
        n_tokens(F.col("text").cast("string")).alias("_tokens"),
    )


def mix(docs: DataFrame, repeats=REPEATS, target_entropy=None, budget=None) -> DataFrame:
    """The documents, all columns, each as often as its source's weight asks for."""
    plan = source_plan(stored(slim_rows(docs)), repeats, target_entropy, budget)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("_id"),
        F.col("source").cast("string").alias("_source"),
        F.struct("*").alias("_doc"),
    )
    return appearances(rows, plan).select("_doc.*")


def query(docs: DataFrame) -> DataFrame:
    """Every appearance of a document: its pass, its block of the permutation and its place in it."""
    slim = stored(slim_rows(docs))
    found = appearances(slim, source_plan(slim, REPEATS, None, None))
    return found.select(
        F.col("_id").alias("doc_id"),
        F.col("_source").alias("source"),
        F.col("_tokens").alias("n_tokens"),
        F.col("_pass").alias("epoch"),
        F.col("_place").alias("place"),
        F.col("_weight").alias("weight"),
    )
