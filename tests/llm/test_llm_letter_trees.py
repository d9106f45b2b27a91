"""Spelling variants against all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from ledgerloom.llm import letter_trees as trees

SCHEMA = "doc_id long, text string"


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_words(rows):
    n = Counter()
    for i, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def expected(n):
    near = {w: [x for x in n if is_near(w, x)] for w in n}
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda x: (-n[x], x.encode()), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted(((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n), key=repr)


def found(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, df.collect()), key=repr)


def edits(draw, word, letters):
    at, c = draw.randrange(len(word)), draw.choice(letters)
    return draw.choice([word[:at] + word[at + 1 :], word[:at] + c + word[at + 1 :], word[:at] + c + word[at:]])


def vocabulary(seed, size, letters="abcdeé×"):
    draw, n = random.Random(seed), {}
    while len(n) < size:
        word = "".join(draw.choice(letters) for _ in range(draw.randrange(6, 10)))
        for _ in range(draw.randrange(1, 12)):
            n[word] = 5 ** draw.randrange(1, 6)
            word = edits(draw, word, letters)
    return n


@pytest.mark.parametrize("leaf, asks, few", [(16_384, 65_536, 32), (30, 7, 4), (1, 1, 1)])
def test_all_pairs(spark, monkeypatch, leaf, asks, few):
    """Cells, blocks and parts of any size give the same links."""
    n = vocabulary(leaf, 400 if leaf > 1 else 40)
    table = spark.createDataFrame(list(n.items()), "word string, n long")
    got = [tuple(r) for r in trees.links(table, leaf, asks, few).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b, n[b]) for a in n for b in n if is_near(a, b)}


def test_words_of_equal_letters(spark):
    """No letter splits the cell: blocks, each visited by all searches."""
    draw, n = random.Random(5), {}
    while len(n) < 60:
        n["".join(draw.sample("aaabbbc", 7))] = 5
    n["aaabbbd"], n["aabbbc"] = 30, 40
    table = spark.createDataFrame(list(n.items()), "word string, n long")
    got = {tuple(r) for r in trees.links(table, 8, 10, 4).collect()}
    assert got == {(a, b, n[b]) for a in n for b in n if is_near(a, b)}


def test_cells_stay_small(spark):
    n = vocabulary(9, 1500)
    table = spark.createDataFrame(list(n.items()), "word string, n long")
    links = trees.F.char_length("word").cast("string").alias("cell")
    points = table.select("word", "n", links)
    none = trees.F.lit(None).cast("string")
    points, asks = trees.placed(points, points.select("*", none.alias("up"), none.alias("down")), 50)
    assert points.count() == len(n)
    assert points.groupBy("cell").count().agg({"count": "max"}).first()[0] <= 50
    assert asks.count() < 40 * len(n)


def test_forms_and_roots(spark):
    n = vocabulary(3, 300) | {"letter": 1000, "lettre": 6, "lettera": 150, "letteras": 20, "tieone": 5, "tietwo": 5, "tiefwo": 25, "tiexwo": 25}
    assert any(r[2] not in (r[0], r[1]) for r in expected(n))
    assert found(trees.variants(spark.createDataFrame(list(n.items()), "word string, n long"))) == expected(n)


def test_whole_texts(spark):
    draw = random.Random(8)
    base = ["".join(draw.choice("abcé") for _ in range(draw.randrange(6, 9))) for _ in range(30)]
    rows = []
    for i in range(400):
        words = [draw.choice(base) for _ in range(20)]
        words += [edits(draw, draw.choice(base), "abcé") for _ in range(3)]
        rows.append((i if i % 9 else None, draw.choice([" ", "\n", "1", "—", "_"]).join(w.title() if i % 2 else w for w in words)))
    n = plain_words(rows)
    assert any(is_near(a, b) for a in n for b in n)
    # a word that only a deletion can make
    assert set(n) - {r for _, t in rows for r in re.findall("[a-zÀ-ÿ]+", t.lower())}
    assert found(trees.query(spark.createDataFrame(rows, SCHEMA))) == expected(n)


def test_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(trees, "LONG_TEXT", 1000)
    rows = [(None, None), (1, ""), (1, "abcdef " * 9), (1, "abcdef " * 9), (2, "ABCDEF abcdeg😀abcdegabcdé " * 40), (3, "x" * 50_000), (3, "×÷×÷×÷ ÿÿÿÿÿÿ " * 6)]
    assert found(trees.query(spark.createDataFrame(rows, SCHEMA))) == expected(plain_words(rows))
    assert found(trees.query(spark.createDataFrame([], SCHEMA))) == []
    wide = spark.createDataFrame([(*r, "n", 1) for r in rows], SCHEMA + ", word string, n long")
    assert found(trees.query(wide)) == expected(plain_words(rows))
