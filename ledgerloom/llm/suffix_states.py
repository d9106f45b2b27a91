"""Language-model scores by a probabilistic suffix tree over tokens.

The symbols are a text's lower-cased words and one end; what precedes a text is an end, too. Contexts are the last 0 to
`DEPTH` tokens. All training texts are counted: first every word, then, length by length, the token strings whose
first and last parts are frequent themselves. A string is frequent if it makes up at least `SHARE` of all training
tokens, and no frequent string is missed, since its parts are as frequent. A context is retained if its next tokens
diverge from those of the context one token shorter: its count times the Kullback-Leibler divergence, in nats, over
the tokens that are frequent after it and all others together, is at least `DIVERGENCE`.

The empty context gives each token (c + 0.5) / (N + 0.5 (V + 1)), one class standing for all unknown words. A retained
context is smoothed towards its longest retained suffix: with N tokens seen after it, r of them not frequent there and
m different frequent ones, P(x) = (count(x) + (r + m) * P_suffix(x)) / (N + m). So all distributions sum to one over the
known tokens and the unknown class. A token is scored in the longest retained suffix of what precedes it.

`SHARE` bounds the model: at most 1 / `SHARE` strings of each length, however large the corpus is, so the tree
travels with the tasks. What is counted grows with the corpus, and so do the other words: their counts are met by a
join on the word. A frequent string costs one pass over the texts for each length.

Defined cases: a null or blank text is an end alone; a null doc_id counts as empty text for the fold (so it is trained
on) and stays null; repeated rows count and are scored each; without training texts every token is unknown and has
probability one. Other columns are ignored. A very long text is worked on in sections that overlap by `DEPTH` tokens,
with the same result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored

DEPTH = 3
SHARE = 1e-6
DIVERGENCE = 20.0
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Tokens that are worked on at once, and different words or strings that a task holds at most.
CHUNK = 1 << 20
HELD = 1 << 20
#: Texts whose words a task holds at once when it scores them.
ROWS = 2000
#: Bits of a token's number in a key; the number of the end.
BITS = 21
END = 0


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()


class Tree(NamedTuple):
    """Frequent strings by length (from 1): sorted keys (number of the string without its last token, last token),
    counts, log10 P of the last token after the others, log10 weight of the suffix if the string is a retained
    context, else NaN. `words` are the frequent words in the order of their numbers, from 1 on."""

    words: list[bytes]
    keys: list[np.ndarray]
    counts: list[np.ndarray]
    scores: list[np.ndarray]
    weights: list[np.ndarray]


def find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each wanted key is among the sorted keys, -1 for none."""
    if not len(keys):
        return np.full(len(wanted), -1)
    # Looked up in their order, so that neighbours read the same part of the keys.
    order = np.argsort(wanted)
    ascending = wanted[order]
    at = np.minimum(np.searchsorted(keys, ascending), len(keys) - 1)
    out = np.empty(len(wanted), at.dtype)
    out[order] = np.where(keys[at] == ascending, at, -1)
    return out


def numbered(row: list[bytes], number: dict[bytes, int]) -> np.ndarray:
    """The numbers of a text's tokens between two ends, -1 for a word without one."""
    tokens = np.full(len(row) + 2, END, np.int64)
    tokens[1:-1] = np.fromiter(map(number.get, row, repeat(-1)), np.int64, len(row))
    return tokens


def pieces(rows: Iterable[list[bytes]], number: dict[bytes, int]):
    """(text, numbers of tokens, first own token) of each text, cut where it is longer than `CHUNK`."""
    for i, row in enumerate(rows):
        tokens = numbered(row, number)
        for at in range(1, len(tokens), CHUNK):
            first = max(0, at - DEPTH)
            yield i, tokens[first : at + CHUNK], at - first


def chunks(parts):
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[1])
        if size >= CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def placed(chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tokens of all pieces, their places in their piece, and which are its own (not only context)."""
    tokens = np.concatenate([t for _, t, _ in chunk])
    sizes = np.array([len(t) for _, t, _ in chunk])
    place = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return tokens, place, place >= np.repeat([f for _, _, f in chunk], sizes)


def key_at(before: np.ndarray, tokens: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """The key of the string of `length` tokens that ends at each token, -1 if a part of it is not frequent."""
    prefix = np.concatenate(([-1], before[:-1]))
    ok = (prefix >= 0) & (tokens >= 0) & (place >= length - 1)
    return np.where(ok, prefix << BITS | tokens, -1)


def strings_at(keys: list[np.ndarray], tokens: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
    """For each length the number of the frequent string that ends at each token, -1 for none."""
    out = [tokens]
    for length, own in enumerate(keys[1:], 2):
        wanted = key_at(out[-1], tokens, place, length)
        at, some = np.full(len(tokens), -1), np.flatnonzero(wanted >= 0)
        at[some] = find(own, wanted[some])
        out.append(at)
    return out


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) of every word of the column text; the end is the empty word."""

    def batches(found):
        words: Counter = Counter()

        def table():
            columns = [pa.array(list(words), pa.binary()).cast(pa.string()), pa.array(list(words.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

        for batch in found:
            for text in batch.column(0).to_pylist():
                words.update(words_of(text))
                words[b""] += 1
                if len(words) > HELD:
                    yield table()
                    words.clear()
        yield table()

    each = texts.select(F.col("text").cast("string")).mapInArrow(batches, "word string, n long")
    return each.groupBy("word").agg(F.sum("n").alias("n"))


def count_longer(texts: DataFrame, words: list[bytes], keys: list[np.ndarray]) -> DataFrame:
    """(key, n) of the strings one token longer than those of `keys` whose two parts are frequent."""
    names, length = b" ".join(words), len(keys) + 1

    def merged(parts):
        all_, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return all_, np.bincount(at, np.concatenate([n for _, n in parts]), len(all_)).astype(np.int64)

    def batches(found):
        number = {w: i for i, w in enumerate(names.split(b" "), 1)} if names else {}
        seen: list = []
        for batch in found:
            rows = (words_of(x) for x in batch.column(0).to_pylist())
            for chunk in chunks(pieces(rows, number)):
                tokens, place, own = placed(chunk)
                numbers = strings_at(keys, tokens, place)
                wanted = key_at(numbers[-1], tokens, place, length)
                if length > 2:
                    # the part without the first token is frequent as well
                    wanted[numbers[-1] < 0] = -1
                seen.append(np.unique(wanted[own & (wanted >= 0)], return_counts=True))
                if sum(len(k) for k, _ in seen) > HELD:
                    seen = [merged(seen)]
                    if len(seen[0][0]) > HELD // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in seen.pop()], names=["key", "n"])
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged(seen)], names=["key", "n"])

    each = texts.select(F.col("text").cast("string")).mapInArrow(batches, "key long, n long")
    return each.groupBy("key").agg(F.sum("n").alias("n"))


def grown(words: list[bytes], root: np.ndarray, total: int, tables, divergence: float = DIVERGENCE) -> Tree:
    """The tree from log10 P of the single tokens, the number of tokens, and (keys, counts) by length (from 1)."""
    keys, counts = [k for k, _ in tables], [n.astype(float) for _, n in tables]
    scores, weights = [root], [np.full(len(root), np.nan)]
    suffix = [np.zeros(len(root), np.int64)]
    shorter = np.array([float(total)])
    for k in range(1, len(keys)):
        prefix, last = keys[k] >> BITS, keys[k] & ((1 << BITS) - 1)
        n, size = counts[k], len(counts[k - 1])
        # the same string without its first token
        own = last if k == 1 else find(keys[k - 1], suffix[k - 1][prefix] << BITS | last)
        before = counts[k - 1][prefix]
        less = counts[k - 1][own] / shorter[suffix[k - 1][prefix]]
        seen = np.bincount(prefix, n, size)
        rest = np.maximum(counts[k - 1] - seen, 0)
        free = np.maximum(1 - np.bincount(prefix, less, size), 1e-12)
        nats = np.bincount(prefix, n * np.log(n / before / less), size)
        with np.errstate(divide="ignore", invalid="ignore"):
            nats += np.where(rest > 0, rest * np.log(rest / counts[k - 1] / free), 0)
        m = np.bincount(prefix, minlength=size)
        kept = (nats >= divergence) & (m > 0)
        weights[k - 1] = np.where(kept, np.log10((rest + m) / (counts[k - 1] + m)), np.nan)
        lower = 10.0 ** scores[k - 1][own]
        smooth = np.log10((n + (rest + m)[prefix] * lower) / (before + m[prefix]))
        scores.append(np.where(kept[prefix], smooth, scores[k - 1][own]))
        weights.append(np.full(len(n), np.nan))
        suffix.append(own)
        shorter = counts[k - 1]
    return Tree(words, keys, counts, scores, weights)


def log_probabilities(tree: Tree, tokens: np.ndarray, place: np.ndarray) -> np.ndarray:
    """log10 P of each token in its longest retained suffix; of a token without a number only the weights."""
    numbers = strings_at(tree.keys, tokens, place)
    out, open_ = np.zeros(len(tokens)), np.ones(len(tokens), bool)
    for k in range(len(tree.keys) - 1, 0, -1):
        context = np.concatenate(([-1], numbers[k - 1][:-1]))
        context[place < k] = -1
        weight = np.where(context >= 0, tree.weights[k - 1][context], np.nan)
        state = open_ & ~np.isnan(weight)
        told = state & (numbers[k] >= 0)
        out[told] += tree.scores[k][numbers[k][told]]
        out[state & ~told] += weight[state & ~told]
        open_ &= ~told
    rest = open_ & (tokens >= 0)
    out[rest] += tree.scores[0][tokens[rest]]
    return out


def fit(texts: DataFrame, words: DataFrame, share: float = SHARE, divergence: float = DIVERGENCE) -> Tree:
    """The tree of the column text, whose words (word, n) are counted. Only frequent strings come to the driver."""
    total, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    least, below = share * total, total + 0.5 * (kinds + 1)
    many = words.where((F.col("n") >= least) | (F.col("word") == "")).orderBy("word").toArrow()
    names, n = [w.encode() for w in many.column("word").to_pylist()], many.column("n").to_numpy()
    if not names:
        names, n = [b""], np.zeros(1, np.int64)
    tables = [(np.arange(len(names)), n)]
    while total and len(tables) <= DEPTH and len(tables[-1][0]):
        found = count_longer(texts, names[1:], [k for k, _ in tables]).where(F.col("n") >= least).orderBy("key").toArrow()
        tables.append((found.column("key").to_numpy(), found.column("n").to_numpy()))
    return grown(names[1:], np.log10((n + 0.5) / below), total, tables, divergence)


def scored(rows: DataFrame, tree: Tree) -> DataFrame:
    """The rows (at, doc_id, held_out, text) with scores; words without a number come out as lists."""
    names, model = b" ".join(tree.words), tree._replace(words=[], counts=[])
    columns = "at long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double"

    def batches(found):
        number = {w: i for i, w in enumerate(names.split(b" "), 1)} if names else {}
        for batch in (b.slice(at, ROWS) for b in found for at in range(0, b.num_rows, ROWS)):
            rows = [words_of(x) for x in batch.column(3).to_pylist()]
            known, base, score = (np.zeros(len(rows)) for _ in range(3))
            for chunk in chunks(pieces(rows, number)):
                tokens, place, own = placed(chunk)
                each = np.where(own, log_probabilities(model, tokens, place), 0.0)
                met = own & (tokens >= 0)
                alone = np.where(met, model.scores[0][tokens], 0.0)
                starts = np.flatnonzero(place == 0)
                for sums, values in ((known, met.astype(float)), (base, alone), (score, each)):
                    np.add.at(sums, [i for i, _, _ in chunk], np.add.reduceat(values, starts))
            rare, often, ends = [], [], [0]
            for row in rows:
                few = Counter([w for w in row if w not in number])
                rare += few
                often += few.values()
                ends.append(len(rare))
            lists = pa.StructArray.from_arrays(
                [pa.array(rare, pa.binary()).cast(pa.string()), pa.array(often, pa.int64())], names=["word", "k"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3], pa.array([len(r) + 1 for r in rows], pa.int64()),
                    pa.array(known.astype(np.int64)), pa.array(base), pa.array(score),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), lists),
                ],
                names=["at", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rare"],
            )

    return rows.mapInArrow(batches, columns + ", rare array<struct<word string, k long>>")


def fold(id_: Column) -> Column:
    return F.crc32(F.coalesce(id_.cast("long").cast("string"), F.lit("")).cast("binary")) % 5


def query(docs: DataFrame, share: float = SHARE) -> DataFrame:
    """The digest of the contract: every text scored by the tree of the texts outside of fold 1."""
    held = fold(F.col("doc_id")) == 1
    training = docs.where(~held)
    words = stored(count_words(training))
    tree = fit(training, words, share)
    total, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    below = total + 0.5 * (kinds + 1)
    rows = docs.select(
        F.monotonically_increasing_id().alias("at"), F.col("doc_id").cast("long").alias("doc_id"),
        held.alias("held_out"), F.col("text").cast("string").alias("text"),
    )
    told = stored(scored(rows, tree))
    few = words.where((F.col("n") < share * total) & (F.col("word") != ""))
    n = F.coalesce("n", F.lit(0))
    more = told.select("at", F.inline("rare")).join(few, "word", "left").groupBy("at").agg(
        F.sum(F.col("k") * F.log10((n + 0.5) / below)).alias("more"), F.sum(F.when(n > 0, F.col("k"))).alias("met")
    )
    extra = F.coalesce("more", F.lit(0.0))
    # without training texts the end has a number but is not known
    known = F.col("n_known") + F.coalesce("met", F.lit(0)) - (0 if total else 1)
    return told.join(more, "at", "left").select(
        "doc_id", "held_out", "n_tokens", known.alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + extra).alias("base_score"), (F.col("score") + extra).alias("score"),
    )
