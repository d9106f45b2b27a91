"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Base rules are fixed. Beyond them each of a few ratios of a text is compared with a cutoff of the text's stratum,
its language. A cutoff is used only if labelled good documents prove that it rejects few of them: for every
cutoff of a fixed grid the number of good documents above it is tested against the limit `RISK / ratios`
with the exact binomial tail. Cutoffs are tested from the loosest on until the first failure, which
needs no correction along the grid; the level is divided by the number of ratios and strata. So with
probability 1 - `LEVEL` no stratum loses more than `RISK` of its good documents to the learned rules.

Counts come from one histogram per stratum, ratio and grid cell, pre-aggregated before the shuffle.
Statistics cover all documents and all labels; nothing comes to the driver.

Defined cases: a null or blank text has no words and fails; a null language is a stratum of its own; a stratum
without good labels, or with too few to prove a cutoff, has no learned rule; labels without a document and labels
that are null do not count; a null id is never labelled; repeated rows each get a verdict. `keep` passes all
other columns through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import bound, stored

#: Share of good documents of a stratum that the learned rules may reject, and the error probability.
RISK = 0.02
LEVEL = 0.05
GRID = 64
#: Fixed values of the base rules.
LEAST_WORDS = 50
MOST_REPEATED = 50
SYMBOLS = "#*$%&|<>"
BLANKS = "\t\n\x0b\f\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " "), "")


def repeated_windows(windows: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more, from the windows' hashes."""

    def covered(at: Column) -> Column:
        reach = F.transform(at, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - x, F.lit(3))))
        return F.aggregate(reach, F.lit(0), lambda total, n: total + n)

    def positions(order: Column) -> Column:
        twice = lambda x, j: (x["h"] == F.get(order, j - 1)["h"]) | (x["h"] == F.get(order, j + 1)["h"])
        return F.transform(F.filter(order, lambda x, j: F.coalesce(twice(x, j), F.lit(False))), lambda x: x["i"])

    order = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    found = bound(order, lambda s: bound(F.sort_array(positions(s)), covered))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), found).otherwise(F.lit(0))


def word_counts(words: Column) -> Column:
    """n_words and n_repeat_words of a list of words."""

    def windows(own: Column) -> Column:
        hashes = F.transform(own, lambda x, i: F.xxhash64(x, F.get(own, i + 1), F.get(own, i + 2)))
        return F.slice(hashes, F.lit(1), F.greatest(F.size(own) - 2, F.lit(0)))

    return bound(
        words,
        lambda own: F.struct(
            F.size(own).cast("long").alias("n_words"),
            bound(windows(own), repeated_windows).cast("long").alias("n_repeat_words"),
        ),
    )


def measured(docs: DataFrame) -> DataFrame:
    """id, text_hash, stratum, the contract's counts and the ratios of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split("_t", "\n"), lambda x: F.length(F.translate(x, " " + BLANKS, "")) > 0)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("stratum"),
        text.alias("_t"),
    )
    rows = rows.select(
        "id",
        "stratum",
        F.xxhash64("_t").alias("text_hash"),
        word_counts(words_of(F.col("_t"))).alias("_w"),
        F.length(F.translate("_t", " " + BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length("_t") - F.length(F.translate("_t", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).alias("n_capitals"),
        bound(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d"))).alias("_l"),
    )
    return rows.select(
        "id",
        "text_hash",
        "stratum",
        F.col("_w.n_words").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.col("_l.n") - F.col("_l.d")).cast("long").alias("n_dup_lines"),
        F.col("_w.n_repeat_words").alias("n_repeat_words"),
        "n_capitals",
        F.col("_l.n").alias("n_lines"),
    )


def ratios() -> dict[str, Column]:
    """Each in [0, 1], larger is worse."""
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    return {
        "symbols": share("n_symbols", "word_chars"),
        "capitals": share("n_capitals", "word_chars"),
        "dup_lines": share("n_dup_lines", "n_lines"),
        "repeats": share("n_repeat_words", "n_words"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(X <= k) of X ~ Bin(n, p), as 1 if k is above the mean."""
    odds = math.log(p / (1 - p))
    first = n * F.lit(math.log1p(-p))

    def more(state: Column, i: Column) -> Column:
        term = state["term"] + F.log((n - i + 1) / i) + F.lit(odds)
        return F.struct(term.alias("term"), (state["total"] + F.exp(term)).alias("total"))

    start = F.struct(first.alias("term"), F.exp(first).alias("total"))
    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.when(k > n * F.lit(p), F.lit(1.0)).otherwise(
        F.aggregate(F.when(k <= n * F.lit(p), steps), start, more, lambda s: s["total"])
    )


def cutoffs(rows: DataFrame, labels: DataFrame, risk: float, level: float) -> DataFrame:
    """(stratum, cuts): for each ratio the smallest proven cutoff in grid cells, absent if there is none."""
    good = (
        labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("id")).where("id IS NOT NULL").distinct()
    )
    names = list(ratios())
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("ratio"), F.floor(ratio * GRID).cast("int").alias("cell"))
            for name, ratio in ratios().items()
        ]
    )
    # a document above a cutoff c has a ratio of (c + 1) / GRID or more
    found = rows.where(~base_failed()).join(good, "id").select("stratum", F.explode(cells).alias("c"))
    counts = found.groupBy("stratum", "c.ratio", "c.cell").agg(F.count("*").alias("n"))
    by_ratio = counts.groupBy("stratum", "ratio").agg(
        F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("cell", "n"))).alias("by_cell")
    )
    above = lambda c: F.aggregate(
        F.sequence(c + 1, F.lit(GRID)),
        F.lit(0).cast("long"),
        lambda total, x: total + F.coalesce(F.try_element_at("by_cell", x), F.lit(0)),
    )
    tested = by_ratio.select(
        "stratum", "ratio", "n", F.explode(F.sequence(F.lit(0), F.lit(GRID - 1))).alias("cut")
    ).join(by_ratio.select("stratum", "ratio", "by_cell"), ["stratum", "ratio"])
    tested = tested.withColumn("k", above(F.col("cut")))
    strata = F.size(F.collect_set("stratum").over(Window.partitionBy(F.lit(0))))
    tested = tested.withColumn("p", binomial_tail(F.col("n"), F.col("k"), risk / len(names)))
    tested = tested.withColumn("limit", F.lit(level) / (len(names) * strata))
    failed = F.coalesce(F.max(F.when(F.col("p") > F.col("limit"), F.col("cut"))), F.lit(-1))
    chosen = tested.groupBy("stratum", "ratio").agg((failed + 1).alias("cut")).where(F.col("cut") < GRID)
    return chosen.groupBy("stratum").agg(
        F.map_from_entries(F.collect_list(F.struct("ratio", "cut"))).alias("cuts")
    )


def judged(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """The measured rows with base_failed, the ratios they break, and kept."""
    at = rows.join(cuts, "stratum", "left")
    broken = F.array_compact(
        F.array(
            *[
                F.when(F.floor(ratio * GRID) > F.try_element_at("cuts", F.lit(name)), F.lit(name))
                for name, ratio in ratios().items()
            ]
        )
    )
    at = at.withColumns({"base_failed": base_failed(), "broken": broken})
    return at.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))


def verdicts(docs: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    rows = stored(measured(docs))
    return judged(rows, cutoffs(rows, labels, risk, level))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return verdicts(docs, labels).select(
        F.col("id").alias("doc_id"), *COUNTS, "base_failed", "kept", F.concat_ws(",", "broken").alias("broken")
    )


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that are kept, with all their columns."""
    gone = verdicts(docs, labels).where("NOT kept").select(F.col("id").alias("gone"), "text_hash").distinct()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("id"), F.xxhash64(text).alias("hash"), F.struct("*").alias("doc")
    )
    same = F.col("id").eqNullSafe(F.col("gone")) & (F.col("hash") == F.col("text_hash"))
    return rows.join(gone, same, "left_anti").select("doc.*")
