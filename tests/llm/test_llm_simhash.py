"""SimHash links against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import simhash_variants as simhash

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text, words):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    parts = WORD.findall(lower)
    if not parts:
        return 0
    shingles = [" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest(ids, fps, bits=3):
    """The smallest id reachable, from all pairs."""
    root = list(range(len(ids)))
    values = np.array(fps, np.uint64)

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(values[i] ^ values[:i]) <= bits).tolist():
            a, b = top(i), top(j)
            root[max(a, b, key=lambda x: ids[x])] = min(a, b, key=lambda x: ids[x])
    return [ids[top(i)] for i in range(len(ids))]


def test_documents_equal_all_pairs(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    ids, fps = [r[0] for r in rows], [plain_fingerprint(r[1], 3) for r in rows]
    out = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.query(docs).collect()}
    assert out == {i: (f"{f:016x}", c) for i, f, c in zip(ids, fps, smallest(ids, fps))}


@pytest.mark.parametrize("bucket", [1024, 3])
def test_clouds_of_fingerprints(spark, bucket):
    """Chains and clouds around a few centres, with buckets cut finer when they may hold three."""
    draw = random.Random(bucket)
    values = set()
    for _ in range(6):
        centre = draw.getrandbits(64)
        for _ in range(60):
            x = centre
            for _ in range(draw.randint(0, 5)):
                x ^= 1 << draw.randrange(64)
            values.add(x)
    values = sorted(values)
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), bucket=bucket)
    root = {v: v for v in signed}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in {(r["a"], r["b"]) for r in found.collect()}:
        root[max(top(a), top(b))] = min(top(a), top(b))
    assert [top(v) for v in signed] == smallest(signed, values)


def test_near_copies_of_long_texts(spark):
    """Two words of four hundred changed: found; half of the text changed: not."""
    draw = random.Random(9)
    rows = []
    for i in range(0, 60, 3):
        words = [f"w{draw.randrange(10**6)}" for _ in range(400)]
        other = list(words)
        for at in (100, 300):
            other[at] = "changed"
        far = words[:200] + [f"x{draw.randrange(10**6)}" for _ in range(200)]
        rows += [(i, " ".join(words)), (i + 1, " ".join(other)), (i + 2, " ".join(far))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for bucket in (simhash.BUCKET, 1):
        nodes = simhash.wide_fingerprints(df, 5).select(F.col("id").alias("node"), "f")
        found = {(r["a"], r["b"]) for r in simhash.wide_links(nodes, simhash.wide_bits(0.8), bucket).collect()}
        assert found == {(i, i + 1) for i in range(0, 60, 3)}
    kept = sorted(r["doc_id"] for r in simhash.keep_first(df).collect())
    assert kept == sorted(set(range(60)) - set(range(1, 60, 3)))


def test_edge_cases(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n", "x"), (4, "One two", "x"), (5, "one TWO", "y"), (6, "é", "z")]
    rows += [(7, "w " * 300_000, "z"), (7, "w " * 300_000, "z"), (None, "one  two", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    out = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.query(df).collect()}
    assert out[1] == out[2] == out[3] == ("0" * 16, 1)
    assert out[4] == out[5] == out[None]  # a missing id is the smallest
    assert out[4][1] is None and out[6][1] == 6 and out[7][1] == 7
    kept = simhash.keep_first(df)
    assert kept.columns == ["doc_id", "text", "fp"]
    # with five words as with three: short texts are one shingle
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "6", "7", "7", "None"]
    assert simhash.query(df.limit(0)).count() == 0


def wide_cloud(n, share, seed, first=0):
    """(node, f): fingerprints around one centre, each bit changed with this probability."""
    draw = random.Random(seed)
    centre, rows = [draw.getrandbits(50) for _ in range(simhash.WIDTH)], []
    for i in range(n):
        f = [c ^ sum((draw.random() < share) << b for b in range(50)) for c in centre]
        rows.append((first + i, f))
    return rows


def test_wide_links_connect_as_all_pairs_of_a_key(spark):
    rows = [r for k, share in enumerate((0.02, 0.06, 0.1)) for r in wide_cloud(60, share, k, 60 * k)]
    f = np.array([r[1] for r in rows], np.uint64)
    top = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            apart = f[a] ^ f[b]
            low, high = (np.bitwise_count(apart & np.uint64(m)) for m in (2**25 - 1, 2**50 - 2**25))
            if (low + high).sum() <= 43 and min(low.min(), high.min()) <= 1:
                top = [min(top[a], top[b]) if t in (top[a], top[b]) else t for t in top]
    assert 3 < len(set(top)) < 150
    found = simhash.wide_links(spark.createDataFrame(rows, "node long, f array<long>"), 43).collect()
    root = list(range(len(rows)))
    for a, b in found:
        root = [min(root[a], root[b]) if t in (root[a], root[b]) else t for t in root]
    assert root == top


def test_wide_links_grow_with_the_group(spark):
    made = []
    for n in (300, 1200):
        nodes = spark.createDataFrame(wide_cloud(n, 0.03, 1), "node long, f array<long>")
        made.append(simhash.wide_links(nodes, 43, bucket=64).count())
    assert made[1] <= 6 * made[0]
