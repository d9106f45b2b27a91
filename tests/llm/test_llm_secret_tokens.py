"""Tokens that the learned formats must get to see."""

from __future__ import annotations

import random

from ledgerloom.llm import secret_grammars


def test_short_and_overlapping_tokens_are_scored(spark):
    draw = random.Random(7)
    pick = lambda chars, n: "".join(draw.choice(chars) for _ in range(n))
    upper = lambda: pick("0123456789", 8) + pick("ABCDEF", 8)
    short = lambda: pick("XYZ", 6) + pick("0123456789", 6)
    holds = lambda: pick("XYZ", 4) + pick("0123456789", 16) + pick("XYZ", 4)
    makers = (upper, short, holds)
    rows = [(i, f"text token = {makers[i % 3]()} more") for i in range(180)]
    alone = [f"Bearer {make()} end" for make in makers]
    plain = "internationalization of mail8.example.com cincinosez.15 34.12.142.58"
    rows += [(1000 + i, text) for i, text in enumerate([*alone, plain])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    clean = {r["doc_id"]: r["text"] for r in secret_grammars.redact(df).collect()}
    assert [clean[1000 + i] for i in range(3)] == ["Bearer [format] end"] * 3
    assert clean[1003] == plain
    out = {r["doc_id"]: r["spans"] for r in secret_grammars.query(df).collect()}
    assert [out[1000 + i] for i in range(3)] == ["format:7:23", "format:7:19", "format:7:31,hex:11:27"]
