"""The conversation trie against a plain dictionary of all prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib

from ledgerloom.llm import truncation_peeling as peeling

SCHEMA = "conv_id long, turn long, role string, text string"


def item_hash(turn):
    role, text = turn
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def ordered(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append(((turn is not None, turn or 0), (role or "", text or "")))
    return {c: [t for _, t in sorted(ts, key=lambda x: (x[0], item_hash(x[1]), len(x[1][1])))] for c, ts in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - int(c - 100 * int(c / 100)), [])[:h] + own[h:]
    return out


def expected(convs):
    members = {}
    for c, path in convs.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    rows = []
    for path, own in members.items():
        below = [p for p in members if p[: len(path)] == path]
        kids = lambda p: sum(len(q) == len(p) + 1 and q[: len(p)] == p for q in members)
        ends = sorted(c for c in own if len(convs[c]) == len(path))
        rows.append((
            min(own), len(path), min(members[path[:-1]]) if path else None, len(own), kids(path),
            sum(kids(p) == 0 for p in below), sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(rows, key=repr)


def found(spark, rows, query=peeling.query):
    out = query(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted([tuple(r) for r in out.collect()], key=repr)


def test_shared_heads_and_endings(spark):
    draw, rows = random.Random(13), [(7 * c, t, "user", f"long {t} {c if t > 8 else 0}") for c in (200, 201, 202) for t in range(40)]
    for c in [*range(0, 40), *range(95, 130), 250, 401, 402, -3, -100]:
        for t in range(draw.randrange(1, 8)):
            rows.append((c, t, draw.choice(["user", "assistant"]), draw.choice(["a", "bé😀", ""])))
    draw.shuffle(rows)
    assert found(spark, rows) == expected(rebuilt(ordered(rows)))


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "no conversation"), (1, None, None, None), (1, 0, "user", "x" * 300_000), (1, 0, "user", "x" * 300_000),
        (1, 1, None, "tie b"), (1, 1, "user", "tie a"), (2, None, "", ""), (2, 2, "user", None), (100, 5, "a", "b"),
        (177, 0, "user", "only own"), (9_000_000_001, 0, "user", "far"),
    ]
    assert found(spark, rows) == expected(rebuilt(ordered(rows)))
    assert found(spark, []) == []


def test_turnless_conversations_are_members_of_the_root(spark):
    """A conversation whose own turns are all replaced by those of a first one that is absent."""
    short = next(c for c in range(501, 600) if zlib.crc32(str(c).encode()) % 6 >= 2)
    rows = [(short, 0, "user", "gone"), (0, 0, "user", "stays")]
    got = found(spark, rows)
    assert got == expected(rebuilt(ordered(rows)))
    root = next(r for r in got if r[1] == 0)
    assert root[3] == 2 and root[7] == hashlib.sha256(str(short).encode()).hexdigest()


def test_many_equal_conversations(spark):
    """Equal paths of many ids: their digest is streamed over blocks of ids."""
    ids = [c * 37 for c in range(2000)]
    a, b = b"a" * 32 + bytes(7) + b"\x05", b"b" * 32 + bytes(8)
    table = spark.createDataFrame([(c, a) for c in ids] + [(c + 1, a + b) for c in ids[:3]], "conv_id long, path binary")
    got = {r["depth"]: r for r in peeling.trie(table).collect()}
    assert got[1]["ends_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert (got[0]["n_convs"], got[1]["n_convs"], got[2]["n_convs"]) == (2003, 2003, 3)
    assert (got[0]["saved_tokens"], got[2]["saved_tokens"]) == (2002 * 5, 0)


def test_extra_columns(spark):
    rows = [(c, t, "user", "hello", 7, "z") for c in range(4) for t in range(3)]
    df = spark.createDataFrame(rows, SCHEMA + ", path long, n_convs string")
    plain = [r[:4] for r in rows]
    assert sorted([tuple(r) for r in peeling.query(df).collect()], key=repr) == expected(rebuilt(ordered(plain)))
