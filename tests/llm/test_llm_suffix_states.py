"""Scores of the probabilistic suffix tree against a plain recursive version over tuples of tokens."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm import suffix_states as lm

SCHEMA = "doc_id long, text string"
COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def tokens_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    out, word = [], ""
    for c in low + " ":
        if c in " \t\n\v\f\r":
            out += [word] if word else []
            word = ""
        else:
            word += c
    return out + [None]  # None is the end


class Plain:
    """All strings in dictionaries, all sums written out."""

    def __init__(self, texts, share, depth=lm.DEPTH, divergence=lm.DIVERGENCE):
        rows = [[None, *tokens_of(t)] for t in texts]
        self.depth, self.divergence = depth, divergence
        self.words = Counter(t for row in rows for t in row[1:])
        self.total, self.kinds = sum(self.words.values()), len(self.words)
        self.n = Counter()
        for row in rows:
            for end in range(1, len(row)):
                for k in range(2, min(depth + 1, end + 1) + 1):
                    self.n[tuple(row[end - k + 1 : end + 1])] += 1
        self.n.update({(w,): c for w, c in self.words.items()})
        self.n = {s: c for s, c in self.n.items() if c >= share * self.total or s == (None,)}
        self.next = {}
        for s, c in self.n.items():
            if len(s) > 1:
                self.next.setdefault(s[:-1], {})[s[-1]] = c
        self.kept = {s for s in self.next if self.diverges(s)}

    def base(self, x):
        return (self.words.get(x, 0) + 0.5) / (self.total + 0.5 * (self.kinds + 1))

    def share_after(self, s, x):
        return self.n[s + (x,)] / (self.n[s] if s else self.total)

    def diverges(self, s):
        c, own = self.n[s], self.next[s]
        nats = sum(k * math.log(k / c / self.share_after(s[1:], x)) for x, k in own.items())
        rest, free = c - sum(own.values()), 1 - sum(self.share_after(s[1:], x) for x in own)
        return nats + (rest * math.log(rest / c / max(free, 1e-12)) if rest else 0) >= self.divergence

    def p(self, s, x):
        if not s:
            return self.base(x)
        if s not in self.kept:
            return self.p(s[1:], x)
        own, c = self.next[s], self.n[s]
        m, rest = len(own), c - sum(own.values())
        return (own.get(x, 0) + (rest + m) * self.p(s[1:], x)) / (c + m)

    def row(self, i, text, held):
        row = tokens_of(text)
        full = [None, *row]
        score = sum(math.log10(self.p(tuple(full[max(0, j - self.depth) : j]), full[j])) for j in range(1, len(full)))
        known = sum(t in self.words for t in row)
        return i, held, len(row), known, self.total, sum(math.log10(self.base(t)) for t in row), score


def held_out(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def expected(rows, share):
    model = Plain([t for i, t in rows if not held_out(i)], share)
    return model, [model.row(i, t, held_out(i)) for i, t in rows]


def compare(spark, rows, share):
    model, want = expected(rows, share)
    out = lm.query(spark.createDataFrame(rows, SCHEMA), share)
    assert out.columns == COLUMNS
    order = lambda r: (repr(r[:5]), round(r[6], 6))
    got, want = sorted((tuple(r) for r in out.collect()), key=order), sorted(want, key=order)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [r[5:] for r in got] == [pytest.approx(r[5:], abs=1e-8) for r in want]
    return model, got


def corpus(n, seed=12):
    draw = random.Random(seed)
    phrases = [[f"w{draw.randrange(40)}" for _ in range(6)] for _ in range(8)]
    rows = []
    for i in range(n):
        words = []
        while len(words) < 40:
            words += draw.choice(phrases) if draw.random() < 0.7 else [f"W{draw.randrange(200)}", f"rare{i}"]
        rows.append((i, " \n".join(words)))
    return rows


@pytest.mark.parametrize("share", [1e-9, 1e-3, 1e-2])
def test_plain_version(spark, share):
    model, got = compare(spark, corpus(150), share)
    assert {len(s) for s in model.kept} == {1, 2, 3} and len(model.kept) < len(model.next)
    held = [r for r in got if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)


def test_distributions_sum_to_one():
    model = Plain([t for _, t in corpus(60)], 1e-3)
    for s in model.kept:
        known = sum(model.p(s, x) for x in model.words)
        assert known + model.p(s, "unknown") == pytest.approx(1)


def test_odd_texts(spark):
    rows = [(None, None), (None, "A b"), (1, ""), (1, ""), (2, " \t\n "), (3, "É É 　É a\x00b"), (4, "x " * 5000), (5, "Tie tie TIE")]
    compare(spark, rows + corpus(30), 1e-3)
    assert lm.query(spark.createDataFrame([], SCHEMA)).collect() == []


def test_no_training_text(spark):
    held = [i for i in range(40) if held_out(i)]
    got = lm.query(spark.createDataFrame([(i, "some words") for i in held], SCHEMA)).collect()
    assert [(r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got] == [(0, 0, 0.0, 0.0)] * len(held)


def test_sections_of_a_long_text(monkeypatch):
    draw = random.Random(2)
    texts = [t for _, t in corpus(40)] + [" ".join(f"w{draw.randrange(40)}" for _ in range(900))]
    model = Plain(texts, 1e-3)
    words = sorted(w.encode() for w in model.words if w is not None)
    tables = [(np.arange(len(words) + 1), np.array([model.words[None], *[model.words[w.decode()] for w in words]]))]
    number = {w: i for i, w in enumerate(words, 1)}

    def whole(chunk):
        monkeypatch.setattr(lm, "CHUNK", chunk)
        rows = [lm.words_of(t) for t in texts]
        keys, found = [tables[0][0]], list(tables)
        for length in (2, 3, 4):
            seen = []
            for part in lm.chunks(lm.pieces(rows, number)):
                tokens, place, own = lm.placed(part)
                wanted = lm.key_at(lm.strings_at(keys, tokens, place)[-1], tokens, place, length)
                seen.append(wanted[own & (wanted >= 0)])
            k, n = np.unique(np.concatenate(seen), return_counts=True)
            found.append((k, n))
            keys.append(k)
        root = np.log10((tables[0][1] + 0.5) / (model.total + 0.5 * (model.kinds + 1)))
        tree = lm.grown(words, root, model.total, found)
        scores = np.zeros(len(texts))
        for part in lm.chunks(lm.pieces(rows, number)):
            tokens, place, own = lm.placed(part)
            each = np.where(own, lm.log_probabilities(tree, tokens, place), 0)
            np.add.at(scores, [i for i, _, _ in part], np.add.reduceat(each, np.flatnonzero(place == 0)))
        return [len(k) for k in keys], scores

    sizes, scores = whole(1 << 20)
    few, short = whole(17)
    assert sizes == few and scores == pytest.approx(short)


def test_extra_columns(spark):
    rows = corpus(20)
    plain = lm.query(spark.createDataFrame(rows, SCHEMA), 1e-3).collect()
    wide = spark.createDataFrame([(*r, 1, "z", None) for r in rows], SCHEMA + ", at long, score string, rare int")
    assert sorted(map(tuple, lm.query(wide, 1e-3).collect())) == [pytest.approx(r) for r in sorted(map(tuple, plain))]


def test_numbers_and_unordered_lookups():
    assert lm.numbered([b"a", b"x", b"b"], {b"a": 1, b"b": 2}).tolist() == [lm.END, 1, -1, 2, lm.END]
    assert lm.numbered([], {}).tolist() == [lm.END, lm.END]
    keys = np.array([2, 3, 5, 7, 11])
    assert lm.find(keys, np.array([11, 4, 2, 12, 2, 1, 7])).tolist() == [4, -1, 0, -1, 0, -1, 3]
    assert lm.find(keys, np.array([], np.int64)).tolist() == [] and lm.find(keys[:0], keys).tolist() == [-1] * 5


def test_scores_do_not_depend_on_the_texts_held(spark, monkeypatch):
    texts = [(i, " ".join(f"w{i * j % 7}" for j in range(i % 9)) + " x" * (i % 3)) for i in range(40)]
    df = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    whole = sorted(map(repr, lm.query(df).collect()))
    monkeypatch.setattr(lm, "ROWS", 3)
    assert sorted(map(repr, lm.query(df).collect())) == whole and len(whole) == 40
