"""The near-copy stage against all pairs of five-word shingle sets."""

from __future__ import annotations

import random

from ledgerloom.llm import simhash_variants as simhash


def shingles(text, words=5):
    parts = (text or "").lower().split()
    return {" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))} if parts else set()


def alike(a, b):
    return a == b or len(a & b) >= 0.8 * len(a | b)


def components(rows):
    """{id: smallest id reachable by pairs of a similarity of 0.8 or more}, from all pairs."""
    sets = {i: shingles(text) for i, text in rows}
    out = {i: i for i in sets}

    def top(i):
        while out[i] != i:
            i = out[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and alike(sets[a], sets[b]):
                x, y = top(a), top(b)
                out[max(x, y)] = min(x, y)
    return {i: top(i) for i in sets}


def changed(words, places):
    return [f"new{at}" if at in places else w for at, w in enumerate(words)]


def found(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["id"]: r["component"] for r in simhash.near_copies(df).collect()}


def test_all_pairs_from_the_limit_on(spark):
    """Pairs and triples of a similarity from 0.80 to 0.85, texts of 30 to 2,000 words."""
    draw, rows, pairs = random.Random(80), [], 0
    for i in range(0, 360, 3):
        words = [f"w{draw.randrange(10**6)}" for _ in range(draw.choice((60, 120, 400, 2000)))]
        # one word changes five shingles
        near = changed(words, set(range(7, len(words) - 7, 54)))
        other = changed(words, set(range(20, len(words) - 7, 54)))
        rows += [(i, " ".join(words)), (i + 1, " ".join(near)), (i + 2, " ".join(other))]
        a, b = shingles(rows[-3][1]), shingles(rows[-2][1])
        pairs += 0.8 <= len(a & b) / len(a | b) <= 0.85
    assert pairs > 80
    assert found(spark, rows) == components(rows)


def test_blocks_of_a_large_key(spark):
    """The join of prefixes alone, with keys cut into blocks."""
    draw, rows = random.Random(3), []
    base = [f"w{draw.randrange(10**6)}" for _ in range(200)]
    for i in range(40):
        rows.append((i, " ".join(changed(base, set(draw.sample(range(200), 4))))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = simhash.described(df, 5, 0.8).collect()
    nodes = spark.createDataFrame([(r["node"], r["size"], r["node"]) for r in got], "node long, size long, root long")
    keys = [(r["node"], at, k) for r in got for at, k in enumerate(r["keys"])]
    keys = spark.createDataFrame(keys, "node long, at int, key long")
    of, sets = {r["node"]: r["id"] for r in got}, {i: shingles(text) for i, text in rows}
    want = {(a, b) for a in sets for b in sets if a < b and alike(sets[a], sets[b])}
    for bucket in (1024, 3):
        pairs = simhash.prefix_pairs(keys, nodes, 0.8, bucket).collect()
        assert want <= {tuple(sorted((of[r["a"]], of[r["b"]]))) for r in pairs}


def test_links_below_the_limit_do_not_count(spark):
    """Texts of a similarity of 0.70 to 0.79 stay apart, however near their fingerprints are."""
    draw, rows = random.Random(75), []
    for i in range(0, 200, 2):
        words = [f"w{draw.randrange(10**6)}" for _ in range(400)]
        rows += [(i, " ".join(words)), (i + 1, " ".join(changed(words, set(range(7, 395, 38)))))]
    a, b = shingles(rows[0][1]), shingles(rows[1][1])
    assert 0.7 < len(a & b) / len(a | b) < 0.79
    assert found(spark, rows) == {i: i for i, _ in rows}


def test_a_word_in_a_hundred(spark):
    """Four words of four hundred changed, a similarity of 0.904: the case that was narrowed to two words."""
    draw, rows = random.Random(9), []
    for i in range(0, 60, 3):
        words = [f"w{draw.randrange(10**6)}" for _ in range(400)]
        other = list(words)
        for at in range(50, 400, 100):
            other[at] = "changed"
        far = words[:200] + [f"x{draw.randrange(10**6)}" for _ in range(200)]
        rows += [(i, " ".join(words)), (i + 1, " ".join(other)), (i + 2, " ".join(far))]
    assert found(spark, rows) == {i: i - (i % 3 == 1) for i in range(60)}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(r["doc_id"] for r in simhash.keep_first(df).collect())
    assert kept == sorted(set(range(60)) - set(range(1, 60, 3)))
