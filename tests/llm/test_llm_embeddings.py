"""Links of the projection forest against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from ledgerloom.llm import projection_forest


def brute(rows):
    n, links, root = len(rows), {}, {i: i for i, _, _ in rows}
    able = [
        (i, np.array(v, float), label)
        for i, v, label in rows
        if label is not None and v and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)
    ]

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    links = dict.fromkeys(root, 0)
    for a in range(len(able)):
        for b in range(a):
            (i, u, k), (j, v, m) = able[a], able[b]
            if k == m and len(u) == len(v) and i != j:
                if u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= 0.98:
                    links[i] += 1
                    links[j] += 1
                    root[max(top(i), top(j))] = min(top(i), top(j))
    return {i: (links[i], top(i)) for i in root}, n


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((12, 32))
    rows = []
    for i in range(700):
        if i % 3 == 0:
            v = centres[i % 12] + rng.standard_normal(32) * 0.05
        elif i % 50 == 1:
            v = centres[0]  # exact copies
        else:
            v = rng.standard_normal(32)
        rows.append((i, [float(x) for x in v], int(i % 2)))
    odd = [None, [], [0.0] * 32, [1.0, None] * 16, [float("nan")] * 32, [float("inf")] * 32, [1.0] * 5]
    rows += [(1000 + k, v, 1) for k, v in enumerate(odd)] + [(2000, rows[1][1], None), (2001, rows[1][1], None)]
    return rows


@pytest.mark.parametrize("block", [1024, 20])
def test_recall_and_components(spark, vectors, monkeypatch, block):
    monkeypatch.setattr(projection_forest, "LEAF", 32)
    monkeypatch.setattr(projection_forest.links, "__defaults__", (block,))
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int").repartition(5)
    out = {r["vec_id"]: r for r in projection_forest.near_duplicates(df).collect()}
    expected, n = brute(vectors)
    assert len(out) == n
    wanted = sum(x for x, _ in expected.values())
    got = sum(r["n_links"] for r in out.values())
    assert wanted > 1000 and got >= 0.99 * wanted
    for i, (links, component) in expected.items():
        assert out[i]["n_links"] <= links
        assert out[i]["component_id"] >= component
        assert out[i]["kept"] == (out[i]["component_id"] == i)
    assert sum(out[i]["component_id"] == c for i, (_, c) in expected.items()) >= 0.99 * n


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int, node string")
    assert projection_forest.near_duplicates(df).count() == 0
