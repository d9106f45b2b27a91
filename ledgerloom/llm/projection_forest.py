"""Embedding near-duplicates by a random-projection tree forest.

Each tree splits vectors of length one by random directions at the median of a sample, again and again.
Vectors near a split go to both sides. Vectors that share a leaf and a label are compared; pairs with a cosine of
`LEAST` or more are linked. Several trees make it unlikely that a pair is parted in all of them.

Equal vectors of one label are merged first and count with their number. A pair that meets in several leaves is
counted only in the first of them, which both vectors know from their own lists of leaves, so no pair is ever
written: a leaf gives each vector its number of links and one link of a spanning tree. A leaf of a label with
more than `BLOCK` vectors is cut into blocks, and pairs of blocks are compared as separate groups, so a
group is bounded and nothing is left out.

The trees are fitted on the driver from at most about `SAMPLE` vectors, picked by hash; every vector is
indexed. Depth follows the number of vectors.

Defined cases: a null label, a null, empty or zero vector and one with null or non-finite components has no
link and is its own component; vectors of different lengths are not compared; rows with equal id and vector are
one vector; a null id counts as the smallest id. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import NO_ID, components, row_id, stored

LEAST = 0.98
TREES = 5
LEAF = 128
BLOCK = 1024
SAMPLE = 20_000
#: Width of the overlap on each side of a split, as a share of a just linked pair's typical distance along it.
SPILL = 0.8
SEED = 7


class Tree:
    """Nodes in breadth order: direction and threshold of inner nodes, number of a leaf."""

    def __init__(self, sample: np.ndarray, depth: int, rng, first_leaf: int):
        self.directions, self.cuts, self.children, self.leaf = [], [], [], []
        todo = [(np.arange(len(sample)), depth)]
        leaves = first_leaf
        while todo:
            own, left = todo.pop(0)
            direction = rng.standard_normal(sample.shape[1])
            direction /= np.linalg.norm(direction)
            along = sample[own] @ direction
            cut = float(np.median(along)) if len(own) else 0.0
            split = left > 0 and len(own) >= 8 and along.min() < along.max()
            number = len(self.leaf)
            self.directions.append(direction if split else None)
            self.cuts.append(cut)
            self.leaf.append(-1 if split else leaves)
            if split:
                self.children.append((number + len(todo) + 1, number + len(todo) + 2))
                todo += [(own[along < cut], left - 1), (own[along >= cut], left - 1)]
            else:
                leaves += 1
                self.children.append(None)
        self.next_leaf = leaves

    def leaves(self, rows: np.ndarray, spill: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) pairs of all rows."""
        at, found = {0: np.arange(len(rows))}, []
        for number, leaf in enumerate(self.leaf):
            own = at.pop(number, None)
            if own is None or not len(own):
                continue
            if leaf >= 0:
                found.append((own, np.full(len(own), leaf)))
                continue
            along = rows[own] @ self.directions[number] - self.cuts[number]
            low, high = self.children[number]
            at[low], at[high] = own[along < spill], own[along >= -spill]
        return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def fit(sample: dict[int, np.ndarray], n: int, trees: int = TREES) -> dict[int, list[Tree]]:
    """The forest of each vector length."""
    depth = max(0, math.ceil(math.log2(max(1, n) / LEAF)))
    out = {}
    for size, rows in sorted(sample.items()):
        rng, first, own = np.random.default_rng(SEED + size), 0, []
        for _ in range(trees):
            own.append(Tree(rows, depth, rng, first))
            first = own[-1].next_leaf
        out[size] = own
    return out


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=-1, keepdims=True)


def nodes_of(vectors: DataFrame) -> DataFrame:
    """id, label, v, node of every row; node is null for vectors that link with nothing."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    able = F.col("label").isNotNull() & F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(row_id("vec_id").alias("id"), F.col("label").cast("string").alias("label"), v.alias("v"), able.alias("able"))
    return rows.select("id", "label", "v", F.when(F.col("able"), F.xxhash64("label", "v")).alias("node"))


def sampled(nodes: DataFrame, n: int, limit: int) -> dict[int, np.ndarray]:
    """About `limit` vectors by length, picked by hash."""
    slots = 2**30
    part = slots if n <= limit else slots * limit // n
    rows = nodes.where(F.pmod(F.xxhash64("node"), F.lit(slots)) < part).select("node", "v").collect()
    by_size: dict[int, list] = {}
    for row in sorted(rows, key=lambda r: r["node"]):
        by_size.setdefault(len(row["v"]), []).append(row["v"])
    return {size: unit(np.array(own)) for size, own in by_size.items()}


def assigned(nodes: DataFrame, forest: dict[int, list[Tree]]) -> DataFrame:
    """node, label, n, v, leaves: every vector with the leaves it falls into."""

    def batches(found):
        for batch in found:
            v = batch.column(3)
            sizes = v.value_lengths().to_numpy(zero_copy_only=False)
            flat = v.flatten().to_numpy(zero_copy_only=False)
            starts = np.concatenate(([0], np.cumsum(sizes)))
            leaves = [[] for _ in sizes]
            for size in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == size)
                rows = unit(flat[starts[own][:, None] + np.arange(size)])
                spill = SPILL * math.sqrt(2 * (1 - LEAST) / size)
                for tree in forest.get(size, []):
                    for i, leaf in zip(*(x.tolist() for x in tree.leaves(rows, spill))):
                        leaves[own[i]].append(leaf)
            arrays = [*batch.columns, pa.array([x or [0] for x in leaves], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["node", "label", "n", "v", "leaves"])

    return nodes.select("node", "label", "n", "v").mapInArrow(
        batches, "node long, label string, n long, v array<double>, leaves array<int>"
    )


def compared(group: list[dict], pair: tuple[int, int]) -> tuple[list[int], list[int], list[int]]:
    """For the vectors of one group with links: node, number of vectors linked here first, a node linked to."""
    rows = np.array([x["v"] for x in group])
    lengths = np.linalg.norm(rows, axis=1)
    near = rows @ rows.T / lengths[:, None] / lengths >= LEAST
    side = np.array([x["block"] for x in group])
    if pair[0] != pair[1]:
        near &= side[:, None] != side
    np.fill_diagonal(near, False)
    linked = np.flatnonzero(near.any(1))
    if not len(linked):
        return [], [], []
    near, group = near[np.ix_(linked, linked)], [group[i] for i in linked]
    ids = sorted({leaf for x in group for leaf in x["leaves"]})
    column = {leaf: i for i, leaf in enumerate(ids)}
    member = np.zeros((len(group), len(ids)), bool)
    for i, x in enumerate(group):
        member[i, [column[leaf] for leaf in x["leaves"]]] = True
    here = column[group[0]["leaf"]]
    earlier = member[:, :here].astype(np.float32)
    first = near & (earlier @ earlier.T == 0)
    weights = np.array([x["n"] for x in group])
    roots, left = np.arange(len(group)), np.ones(len(group), bool)
    for start in range(len(group)):
        queue = [start] if left[start] else []
        left[start] = False
        while queue:
            found = np.flatnonzero(near[queue.pop()] & left)
            left[found] = False
            roots[found] = start
            queue += found.tolist()
    nodes = [x["node"] for x in group]
    return nodes, (first @ weights).tolist(), [nodes[i] for i in roots]


def links(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """node, links, root of every vector with links in a group; links add up over the groups."""
    key = ["label", "size", "leaf"]
    placed = rows.select("*", F.size("v").alias("size"), F.explode("leaves").alias("leaf"))
    sizes = placed.groupBy(*key).agg(F.count("*").alias("m")).where("m > 1")
    blocks = F.ceil(F.col("m") / block).cast("int")
    cut = placed.join(sizes, key).withColumn("blocks", blocks)
    cut = cut.withColumn("block", F.pmod(F.xxhash64("node", F.lit(SEED)), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    groups = cut.groupBy(*key, "low", "high").agg(
        F.collect_list(F.struct("node", "n", "v", "leaves", "leaf", "block")).alias("own")
    )

    def batches(found):
        for batch in found:
            for low, high, own in zip(*(batch.column(i) for i in range(3))):
                node, n, root = compared(own.as_py(), (low.as_py(), high.as_py()))
                if node:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(node, pa.int64()), pa.array(n, pa.int64()), pa.array(root, pa.int64())],
                        names=["node", "links", "root"],
                    )

    return groups.select("low", "high", "own").mapInArrow(batches, "node long, links long, root long")


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    rows = nodes_of(vectors)
    one = rows.where("node IS NOT NULL").groupBy("node", "id").agg(
        F.any_value("label").alias("label"), F.any_value("v").alias("v")
    )
    nodes = stored(
        one.groupBy("node").agg(
            F.count("*").alias("n"),
            F.min("id").alias("least"),
            F.any_value("label").alias("label"),
            F.any_value("v").alias("v"),
        )
    )
    n = nodes.count()
    forest = fit(sampled(nodes, n, SAMPLE), n)
    found = stored(links(assigned(nodes, forest)))
    number = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.where("node != root"), "node", "root")
    named = (
        nodes.select("node", "n", "least")
        .join(number, "node", "left")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    told = named.join(least, "root").select(
        F.col("node"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component"
    )
    out = rows.select("id", "node").join(told, "node", "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.nullif("id", F.lit(NO_ID)).alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.nullif(component, F.lit(NO_ID)).alias("component_id"),
        (F.col("id") == component).alias("kept"),
    )
