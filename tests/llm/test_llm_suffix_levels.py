"""Removal of repeated passages against a scan of every 100-byte string."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from ledgerloom.llm import suffix_levels

FOLDER = "/root/testdata/sf0.001"


def brute(rows):
    seen, out = set(), {}
    for id_, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for at in range(len(raw) - 99):
            window = raw[at : at + 100]
            if window in seen:
                gone[at : at + 100] = b"\1" * 100
            seen.add(window)
        spans = sum(1 for k in range(len(raw)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(c for c, x in zip(raw, gone) if not x)
        out[id_] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def found(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}


@pytest.fixture(scope="module")
def passages():
    draw = random.Random(3)
    shared = ["".join(draw.choice("abcdefgh ") for _ in range(draw.randint(90, 400))) for _ in range(6)]
    rows = []
    for i in range(400):
        text = ""
        for _ in range(draw.randint(0, 4)):
            kind = draw.random()
            if kind < 0.4:
                text += draw.choice(shared)[draw.randint(0, 60) :]
            elif kind < 0.5:
                text += draw.choice(["ab", "xyzzy", "é", "q", "0123456789"]) * draw.randint(1, 120)
            else:
                text += "".join(draw.choice("abcdefgh ") for _ in range(draw.randint(0, 300)))
        rows.append((i * 3 % 401, text))
    return rows + [(5000, None), (5001, ""), (5002, "a" * 1000), (5003, "\0" * 500)]


@pytest.mark.parametrize(("share", "part"), [(512, 2_000_000), (4, 2_000_000), (512, 150)])
def test_equals_brute_force(spark, passages, monkeypatch, share, part):
    monkeypatch.setattr(suffix_levels, "SHARE", share)
    monkeypatch.setattr(suffix_levels, "PART", part)
    df = spark.createDataFrame(passages, "doc_id long, text string").repartition(5)
    assert found(suffix_levels.query(df)) == brute(passages)


def test_equals_brute_force_on_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert found(suffix_levels.query(docs)) == brute(rows)


def test_empty_clashing_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, id int, own string")
    assert suffix_levels.query(empty).count() == 0
    rows = [(1, "x" * 150, 7, "a"), (1, "x" * 150, 7, "a"), (None, "yz" * 100, 1, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, id int, own string")
    out = sorted((r["doc_id"] is None, r["n_removed"]) for r in suffix_levels.query(df).collect())
    # one letter repeats from its second place on, in both copies alike
    assert out == [(False, 149), (False, 149), (True, 198)]


def test_rows_of_one_id_and_without_one(spark, monkeypatch):
    """Different texts of one id, or of none, are documents of their own, ordered by their hashes."""
    draw = random.Random(8)

    def noise(n):
        return "".join(draw.choice("abcdefghijklmnop ") for _ in range(n))

    shared = noise(160)
    rows = [(i, noise(draw.randint(50, 400)) + shared * (k % 4 > 0) + noise(300)) for k, i in enumerate((None, None, None, 2, 2, 2, 5))]
    rows += [(None, "a" * 400), (None, noise(500)), (2, noise(400)), (2, None), (None, ""), *rows[:2], rows[4]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    hashes = df.selectExpr("doc_id", "text", "xxhash64(cast(coalesce(text, '') AS binary)) AS h").distinct().collect()
    order = sorted({(-1 if r["doc_id"] is None else r["doc_id"], r["h"], r["text"] or "") for r in hashes})
    want = brute([(k, text) for k, (_, _, text) in enumerate(order)])
    want = {(None if id_ < 0 else id_, *want[k]) for k, (id_, _, _) in enumerate(order)}
    assert sum(x[2] > 0 for x in want) > 4
    for share in (512, 2):
        monkeypatch.setattr(suffix_levels, "SHARE", share)
        out = suffix_levels.query(df).collect()
        assert len(out) == len(rows)
        assert {(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out} == want
    # a clean text keeps all of its bytes, whatever other texts of its id lose
    clean = [(None, "x" * 400), (None, noise(400)), (7, "yz" * 300), (7, noise(500))]
    out = suffix_levels.query(spark.createDataFrame(clean, "doc_id long, text string")).collect()
    assert sorted(r["n_removed"] for r in out) == [0, 0, 399, 598]


def test_levels_merge_and_find():
    draw = random.Random(1)
    levels, seen = suffix_levels.Levels(), set()
    for _ in range(20):
        batch = [bytes([draw.randrange(3)] * 99 + [draw.randrange(40)]) for _ in range(30)]
        expected = []
        for x in batch:
            expected.append(x in seen)
            seen.add(x)
        got = levels.add(np.array(batch, "S100"))
        assert got.tolist() == expected
        sizes = [size for size, _ in levels.levels]
        assert sizes == sorted(sizes, reverse=True) and len(sizes) <= 6
