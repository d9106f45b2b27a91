"""Spelling variants by k-d trees over letter counts.

A word is a point: how often it has each letter. One edit moves the point by at most one step up in one letter and one
step down in one letter, so two words of one length that are near differ by one up and one down, and a word one letter
longer by one up. For each pair of lengths the longer (or equal) words are held in a k-d tree, and every word searches
it with that box: at a split it goes to the other side only if one step takes it there and the step is still free.
What meets in a leaf is verified letter by letter.

The upper splits are made by Spark: while a cell of a tree holds more than `LEAF` words, the letter and the count that
halve it best are found by an aggregate over all its words, and words and searches move on by a join with the splits.
So cells stay bounded at any number of words, and no word leaves the search. A cell that no letter splits (words of
equal letters) is dealt out in blocks, and its searches visit all of them. Searches of a cell are split from `ASKS` on,
each part with its own copy of the cell. Inside a cell the same splits go on down to `FEW` words.

`variants` follows each word's form: its near word of largest count, if that is at least `RATIO` times the word's own.

Defined cases: null and empty texts have no words; a null doc_id is empty text in what decides about a deletion; rows of
one doc_id and repeated rows count each; an empty table gives no words. Other columns are ignored. A very long text is
read run by run.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import dropped, stored

RUN = r"[A-Za-zÀ-ÿ]{%d,}"
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
LEAST_LETTERS = 6
LEAST_COUNT = 5
RATIO = 5
#: One run in this many loses a letter.
DELETE = 199
LEAF = 16_384
ASKS = 65_536
FEW = 32
#: Different words that a task holds at most, and letters compared at once.
HELD = 1 << 19
CELLS = 1 << 22
LONG_TEXT = 1 << 20


def words(docs: DataFrame, letters: int = LEAST_LETTERS, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the results of the runs of letters of the texts, of at least so many letters and occurrences."""
    # a run of fewer letters has no result that is long enough
    run = re.compile(RUN % letters)

    def batches(found):
        seen: Counter = Counter()

        def table():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"]
            )

        for batch in found:
            for head, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                low = (text or "").encode("utf-8").translate(LOWER).decode("utf-8")
                own = run.findall(low) if len(low) < LONG_TEXT else (m.group() for m in run.finditer(low))
                start = zlib.crc32(head.encode())
                for word, k in Counter(own).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % DELETE == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < letters:
                            continue
                    seen[word] += k
                if len(seen) > HELD:
                    yield table()
                    seen.clear()
        yield table()

    head = F.concat(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")), F.lit(":"))
    rows = docs.select(head.alias("head"), F.col("text").cast("string"))
    counted = rows.mapInArrow(batches, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least)


def letters_in(word: str, letter: str):
    return F.length(word) - F.length(F.replace(F.col(word), F.col(letter), F.lit("")))


def splits(points: DataFrame, leaf: int) -> DataFrame:
    """(cell, letter, top, blocks) of the cells that hold too many points: words with at most `top` of the letter go
    left; without a letter that splits the cell, `blocks` parts."""
    full = points.groupBy("cell").agg(F.count("*").alias("size")).where(F.col("size") > leaf)
    each = points.join(full, "cell").select("cell", "size", "word", F.explode(F.array_distinct(F.split("word", ""))).alias("letter"))
    counted = each.where("letter != ''").withColumn("k", letters_in("word", "letter"))
    by_count = counted.groupBy("cell", "size", "letter", "k").agg(F.count("*").alias("n"))
    # a cell has few rows here: letters times counts
    lists = by_count.groupBy("cell", "size", "letter").agg(F.collect_list(F.struct("k", "n")).alias("own"))
    cut = lists.select("cell", "size", "letter", "own", F.explode("own.k").alias("k"))
    right = F.aggregate(
        "own", F.lit(0).cast("long"), lambda total, x: total + F.when(x["k"] >= F.col("k"), x["n"]).otherwise(0)
    )
    choice = F.struct(F.least(right, F.col("size") - right).alias("even"), "letter", (F.col("k") - 1).alias("top"))
    best = cut.groupBy("cell", "size").agg(F.max(choice).alias("best"))
    useful = F.col("best.even") > 0
    blocks = F.ceil(F.col("size") / leaf).cast("int")
    return best.select(
        "cell", F.when(useful, F.col("best.letter")).alias("letter"), F.when(useful, F.col("best.top")).alias("top"),
        F.when(useful, F.lit(0)).otherwise(blocks).alias("blocks"),
    )


def side(cell: str, which) -> F.Column:
    return F.concat(F.col(cell), F.lit("/"), which.cast("string"))


def placed(points: DataFrame, asks: DataFrame, leaf: int = LEAF) -> tuple[DataFrame, DataFrame]:
    """Points (word, n, cell) and asks (word, n, cell, up, down) moved to cells of at most `leaf` points.

    up and down are the letters whose step a search has used, null while the step is free, empty if it has none."""
    while True:
        cuts = stored(splits(points.where("NOT instr(cell, '#') > 0"), leaf))
        if cuts.isEmpty():
            return points, asks
        block = F.concat(F.col("cell"), F.lit("#"), F.pmod(F.xxhash64("word"), "blocks").cast("string"))
        right = F.when(letters_in("word", "letter") > F.col("top"), F.lit(1)).otherwise(0)
        cell = F.when(F.col("letter").isNull() & F.col("blocks").isNull(), F.col("cell"))
        cell = cell.when(F.col("blocks") > 0, block).otherwise(side("cell", right))
        # an inner cell of one round is spread over many rows: Spark broadcasts the few splits or cuts skewed keys
        moved = stored(points.join(cuts, "cell", "left").select("word", "n", cell.alias("cell")))
        step = lambda used: F.when(F.col(used) == F.col("letter"), 1).otherwise(0)
        now = letters_in("word", "letter") + step("up") - step("down")
        top, letter, up, down = (F.col(c) for c in ("top", "letter", "up", "down"))
        way = lambda n, u, d: F.struct(side("cell", F.lit(n)).alias("cell"), u.alias("up"), d.alias("down"))
        left = F.when(now <= top, way(0, up, down)).when((now == top + 1) & down.isNull(), way(0, up, letter))
        over = F.when(now > top, way(1, up, down)).when((now == top) & up.isNull(), way(1, letter, down))
        all_blocks = F.transform(
            F.sequence(F.lit(0), F.col("blocks") - 1),
            lambda i: F.struct(F.concat(F.col("cell"), F.lit("#"), i.cast("string")).alias("cell"), up.alias("up"), down.alias("down")),
        )
        stay = F.array(F.struct("cell", "up", "down"))
        ways = F.when(F.col("blocks").isNull(), stay).when(F.col("blocks") > 0, all_blocks)
        ways = ways.otherwise(F.array_compact(F.array(left, over)))
        points, asks = moved, stored(asks.join(cuts, "cell", "left").select("word", "n", F.inline(ways)))


def counts_of(letters: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """How often each row of letters has each letter of the alphabet."""
    out = np.zeros((len(letters), 256), np.int16)
    np.add.at(out, (np.arange(len(letters))[:, None], letters), 1)
    return out[:, alphabet]


def matrix(rows: list[str]) -> np.ndarray:
    """The letters of words of one length; all are below 256."""
    return np.frombuffer("".join(rows).encode("latin-1"), np.uint8).reshape(len(rows), -1)


def near(asks: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Which words of one length are one replaced or (in longer points) one inserted letter apart, all by all."""
    if asks.shape[1] == points.shape[1]:
        return (asks[:, None, :] != points[None, :, :]).sum(2) == 1
    n = asks.shape[1]
    same = asks[:, None, :] == points[None, :, :n]
    lead = np.logical_and.accumulate(same, 2).sum(2)
    same = asks[:, None, ::-1] == points[None, :, :0:-1]
    return lead + np.logical_and.accumulate(same, 2).sum(2) >= n


def search(points: np.ndarray, asks: np.ndarray, up: np.ndarray, down: np.ndarray, few: int = FEW) -> np.ndarray:
    """Rows (ask, point) of near words: letters of the points, letters of the asks, and the letters whose step an ask
    has used (-1: the step is free, -2: it has none)."""
    alphabet = np.unique(points)
    own, theirs = counts_of(points, alphabet), counts_of(asks, alphabet)
    place = np.full(258, -3)
    place[alphabet] = np.arange(len(alphabet))
    place[-1], place[-2] = -1, -2
    stack = [(np.arange(len(points)), np.arange(len(asks)), place[up], place[down])]
    out = [np.zeros((0, 2), np.int64)]
    while stack:
        p, a, u, d = stack.pop()
        if not len(a):
            continue
        best = (0, 0, 0)
        if len(p) > few:
            here = own[p]
            for top in range(int(here.max())):
                left = (here <= top).sum(0)
                even = np.minimum(left, len(p) - left)
                best = max(best, (int(even.max()), int(even.argmax()), top))
        even, letter, top = best
        if not even:
            part = max(1, CELLS // max(1, len(p) * points.shape[1]))
            for i in range(0, len(a), part):
                x, y = np.nonzero(near(asks[a[i : i + part]], points[p]))
                out.append(np.stack([a[i : i + part][x], p[y]], 1))
            continue
        right = own[p, letter] > top
        now = theirs[a, letter] + (u == letter) - (d == letter)
        free, steps = now <= top, (now == top + 1) & (d == -1)
        go = free | steps
        stack.append((p[~right], a[go], u[go], np.where(steps[go], letter, d[go])))
        free, steps = now > top, (now == top) & (u == -1)
        go = free | steps
        stack.append((p[right], a[go], np.where(steps[go], letter, u[go]), d[go]))
    return np.concatenate(out)


def links(found: DataFrame, leaf: int = LEAF, asks_at_once: int = ASKS, few: int = FEW) -> DataFrame:
    """(word, near, n): each word of (word, n) with each of its near words and that one's n."""
    length = F.char_length("word")
    none = F.lit(None).cast("string")
    points = found.select("word", "n", length.cast("string").alias("cell"))
    same = points.select("*", none.alias("up"), none.alias("down"))
    longer = found.select("word", "n", (length + 1).cast("string").alias("cell"), none.alias("up"), F.lit("").alias("down"))
    points, asks = placed(points, same.union(longer), leaf)
    sizes = asks.groupBy("cell").agg(F.ceil(F.count("*") / asks_at_once).cast("int").alias("parts"))
    copies = points.join(sizes, "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), "word", "n",
        none.alias("up"), none.alias("down"),
    )
    dealt = asks.join(sizes, "cell").select(
        "cell", F.pmod(F.xxhash64("word"), "parts").cast("int").alias("part"), F.lit(1).alias("kind"), "word", "n", "up", "down"
    )
    keys = ["cell", "part"]
    ordered = copies.union(dealt).repartition(*keys).sortWithinPartitions(*keys, "kind")

    def told(points, asks):
        """The links between the points and asks (word, n, up, down) of one cell."""
        name, n = points
        of = np.array([len(a[0]) for a in asks])
        code = lambda x, used: -1 if x is None else -2 if x == "" else ord(x)
        for size in np.unique(of):
            own = [asks[i] for i in np.flatnonzero(of == size)]
            up, down = (np.array([code(a[i], i) for a in own]) for i in (2, 3))
            for i, j in search(matrix(name), matrix([a[0] for a in own]), up, down, few).tolist():
                yield own[i][0], name[j], n[j]
                if size < len(name[j]):
                    yield name[j], own[i][0], own[i][1]

    def batches(rows):
        cell, name, n = None, [], []
        for batch in rows:
            columns = [c.to_pylist() for c in batch.columns]
            out, asks = [], []
            for *key, kind, word, count, up, down in zip(*columns):
                if key != cell:
                    if asks and name:
                        out += told((name, n), asks)
                    cell, name, n, asks = key, [], [], []
                if kind:
                    asks.append((word, count, up, down))
                else:
                    name.append(word)
                    n.append(count)
            if asks and name:
                out += told((name, n), asks)
            kinds = (pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names=["word", "near", "n"]
            )

    return ordered.mapInArrow(batches, "word string, near string, n long")


def variants(found: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a table (word, n) of distinct words."""
    best = F.min(F.struct((-F.col("n")).alias("n"), "near")).alias("best")
    of = links(found).groupBy("word").agg(F.count("*").alias("n_near"), best)
    strong = -F.col("best.n") >= ratio * F.col("n")
    told = stored(
        found.join(of, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.n")).alias("form_n"),
        )
    )
    # counts grow at least fivefold from form to form, so the chains are short; each round doubles the step
    roots, steps = stored(told.where("form IS NOT NULL").select("word", F.col("form").alias("root"))), True
    while steps:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        next_ = stored(roots.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), "further"))
        steps = not next_.where("further IS NOT NULL").isEmpty()
        dropped(roots)
        roots = next_.drop("further")
    return told.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def query(docs: DataFrame) -> DataFrame:
    """The digest of the contract."""
    return variants(stored(words(docs)))
