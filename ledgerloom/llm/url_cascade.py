"""URL filter by a Bloom filter cascade, in DataFrame functions only.

The first level is a Bloom filter of the listed keys. Keys of the corpus that pass it without being listed are
encoded by the second level, listed keys that pass the second by the third, and so on until a level has no false
positive. Because the levels are built over all keys of the corpus, probing them in turn gives exact
membership: the first level that lacks a key decides. A probe is bit tests on arrays that reach
every task as scalar subqueries; the corpus is not joined or shuffled.

A level's bits are laid out by its number of keys and hold at most `MOST_BITS`. Larger lists are told
by an equality join on the key instead, which has the same result.

Defined cases: a null url or one without `://` has empty host and path; empty lists and tables work, repeated rows
each give a row; a url that no rule and no list entry covers is allowed. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import shared_folder, stored

#: The rules (host, path), and the domains whose pages the list blocks.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
BLOCKED = (
    "adult-x.example.com", "adult-x.example.net", "adult-x.example.org", "ads-track.example.com",
    "ads-track.example.net", "ads-track.example.org", "casino-win.example.com", "casino-win.example.net",
    "casino-win.example.org", "cheap-pills.example.com", "cheap-pills.example.net",
    "cheap-pills.example.org", "free-bets.example.com", "free-bets.example.net", "free-bets.example.org",
    "spam-farm.example.com", "spam-farm.example.net", "spam-farm.example.org",
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASHES = 5
BITS_PER_KEY = 10
#: 4 MB a level; beyond it the list is joined.
MOST_BITS = 2**25
MOST_LEVELS = 64


def split_url(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fits_domain(host: Column, domain: str) -> Column:
    return (host == domain) | host.endswith(f".{domain}")


def ruled(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest fitting rule, as its text, and its verdict."""
    order = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [fits_domain(host, domain) & path.startswith(start) for _, domain, start in order]
    rule = F.coalesce(*[F.when(f, F.lit(d + p)) for f, (_, d, p) in zip(fits, order)])
    verdict = F.coalesce(*[F.when(f, F.lit(v)) for f, (v, _, _) in zip(fits, order)])
    return rule, verdict


def bit(key: Column, level: int, i: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(bits))


def filter_of(keys: DataFrame, level: int, bits: int) -> DataFrame:
    """One row with the bits of a level's keys, 64 in a word."""
    at = keys.select(F.explode(F.array(*[bit(F.col("key"), level, i, bits) for i in range(HASHES)])).alias("at"))
    words = at.select(
        F.floor(F.col("at") / 64).cast("long").alias("word"),
        F.expr("shiftleft(1L, CAST(at % 64 AS INT))").alias("mask"),
    ).union(keys.sparkSession.range(bits // 64).select("id", F.lit(0).cast("long")))
    words = words.groupBy("word").agg(F.bit_or("mask").alias("mask"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("word", "mask"))), lambda x: x["mask"])
    return words.agg(listed.alias("words"))


def holds(words: Column, key: Column, level: int, bits: int) -> Column:
    """Whether all bits of a key are set."""

    def one(i: int) -> Column:
        at = bit(key, level, i, bits)
        word = F.get(words, F.floor(at / 64).cast("int"))
        return F.call_function("getbit", word, (at % 64).cast("int")) == 1

    return reduce(lambda a, b: a & b, [one(i) for i in range(HASHES)])


class Cascade:
    """Levels as (table of one row, bits); empty if nothing is listed."""

    def __init__(self, universe: DataFrame, most_bits: int = MOST_BITS):
        """`universe`: key and listed, one row for each key of the corpus."""
        self.levels: list[tuple[DataFrame, int]] = []
        self.exact: DataFrame | None = None
        alive, side = stored(universe.select("key", "listed")), True
        while True:
            n = alive.where(F.col("listed") == side).count()
            if not n:
                return
            bits = max(64, 1 << (n * BITS_PER_KEY - 1).bit_length())
            if bits > most_bits or len(self.levels) == MOST_LEVELS:
                self.levels, self.exact = [], alive_listed(universe)
                return
            level = len(self.levels)
            words = stored(filter_of(alive.where(F.col("listed") == side), level, bits))
            self.levels.append((words, bits))
            passes = holds(words.scalar(), F.col("key"), level, bits)
            # the keys this level encodes go on as what the next one may let through by mistake
            alive = stored(alive.where((F.col("listed") == side) | passes))
            side = not side

    def member(self, key: Column) -> Column:
        """Whether the first level that lacks the key is one of false positives."""
        inside = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(range(len(self.levels))):
            words, bits = self.levels[level]
            inside = F.when(holds(words.scalar(), key, level, bits), inside).otherwise(F.lit(level % 2 == 1))
        return inside


def alive_listed(universe: DataFrame) -> DataFrame:
    return stored(universe.where("listed").select(F.col("key").alias("_listed")))


def judge(pages: DataFrame, rules=RULES, blocked=BLOCKED, most_bits: int = MOST_BITS) -> DataFrame:
    """page_id, url, host, path, rule, verdict, listed of every page."""
    host, path = split_url(F.col("url").cast("string"))
    rows = pages.select(F.col("page_id").cast("long"), "url", host.alias("host"), path.alias("path"))
    key = F.concat("host", "path")
    on_list = reduce(lambda a, b: a | b, [fits_domain(F.col("host"), d) for d in blocked], F.lit(False))
    universe = rows.groupBy(key.alias("key")).agg(F.max(on_list).alias("listed"))
    cascade = Cascade(universe, most_bits)
    if cascade.exact is not None:
        listed = F.col("_listed").isNotNull()
        rows = rows.join(cascade.exact, key == F.col("_listed"), "left")
    else:
        listed = cascade.member(key)
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("listed", listed)
    return rows.select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "listed",
    )
