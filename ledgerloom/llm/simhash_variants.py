"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint has one bit per position that is set in over half of the hashes of a text's shingles.
Two fingerprints that differ in at most three bits differ in at most one bit in one of their two
halves. So each half is indexed once per bit with that bit left out; equal keys meet in an equality
join on the key and are then compared bit by bit.

Equal fingerprints are merged first, so copies of one text are a single row of the index. A key that
more than `BUCKET` fingerprints share is cut finer by the same argument on the free half: its two
quarters, then two eighths, again with one bit left out. After that 53 bits are fixed, which leaves at
most 2,048 different fingerprints, so no bucket grows with the data and no link is lost. Buckets give
the links of a spanning tree, not all their pairs; components need no more.

`near_copies` finds all texts whose sets of shingles have a similarity (shared over all) of `SIMILARITY` or
more. Texts of equal sets are one node. Two sets that are similar share one of the first fifth of their shingles
in any common order, so an equality join on those prefixes leaves no pair out; common shingles come last in
the order. Large groups are linked first, at little cost, by a fingerprint of 250 bits in ten segments of 25
bits with one bit left out each. Then, in `ROUNDS` rounds (one), one text of each key is compared with all others of
the key that are not linked to it yet, no more pairs than rows. Last, the join of prefixes compares all texts of a key
that are still not linked, so nothing is left out; sizes, places and sketches rule a pair out before it is written.
Every link of all kinds is verified on the whole sets.
Equality is that of 64-bit hashes. A key that more than `BUCKET` texts share is cut into blocks, and pairs of
blocks are compared as separate groups.

Defined cases: a null or blank text has fingerprint zero and is linked like any other; a text of
fewer words than a shingle is one shingle; a null doc_id takes part and has the smallest id. Rows of one doc_id
may have different texts: `keep_first` tells rows apart by doc_id and a 64-bit hash of the text, puts a null doc_id
last and keeps one of equal rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import NO_ID, components, dropped, row_id, stored

SEED = 42
BITS = 3
BUCKET = 1024
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Shingles that are hashed at once, to keep memory bounded on very long texts.
CHUNK = 1 << 18
#: Similarity of the shingle sets (shared over all) from which `near_copies` links.
SIMILARITY = 0.8
#: Its bits are kept in longs of two segments each.
WIDTH = 5
SEGMENT = 25
#: Marks the key of a segment that gives all links of its nodes, not only those between its two values.
WHOLE = 2
#: Documents that are sampled for common shingles, the least count of one in the sample, and how many are kept.
SAMPLE = 20_000
COMMON = 4
COMMON_KEPT = 50_000
#: Bits of the sketch of a set, rounds of comparing with one node of each key, pairs held at once.
SKETCH = 2048
ROUNDS = 1
HELD_PAIRS = 200_000
#: Rows whose results a task holds at once.
ROWS = 1000
#: Bits of the filter that spares hashing the texts of documents without a candidate.
FILTER = 1 << 20


def fingerprint(text: str | None, words: int) -> int:
    """The 64-bit fingerprint of one whole text."""
    parts = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(parts) - words + 1)
    first, last = starts[:n].tolist(), ends[min(words, len(parts)) - 1 :].tolist()
    counts = np.zeros(2048, np.int64)
    digest = xxhash.xxh64_intdigest
    for k in range(0, n, CHUNK):
        hashes = np.array(
            [digest(joined[i:j], SEED) for i, j in zip(first[k : k + CHUNK], last[k : k + CHUNK])],
            dtype="<u8",
        )
        bytes_ = hashes.view(np.uint8).reshape(-1, 8) + np.arange(0, 2048, 256)
        counts += np.bincount(bytes_.ravel(), minlength=2048)
    ones = counts.reshape(8, 256) @ np.unpackbits(
        np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little"
    ).astype(np.int64)
    set_ = (ones.ravel() * 2 > n).astype(np.uint8)
    return int(np.packbits(set_, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """(id, fp) of every row; fp is the fingerprint as a signed long."""

    def batches(found):
        for batch in found:
            fps = np.array([fingerprint(x, words) for x in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"]
            )

    rows = docs.select(row_id().alias("id"), F.col("text").cast("string"))
    return rows.mapInArrow(batches, "id long, fp long")


def signed(mask: int) -> int:
    return mask - 2**64 if mask >= 2**63 else mask


def one_wildcard(start: int, width: int) -> list[int]:
    """The masks of a segment with one bit left out each."""
    segment = ((1 << width) - 1) << start
    return [segment & ~(1 << bit) for bit in range(start, start + width)]


def finer(width: int) -> Column:
    """For the segment of this width that a mask leaves free: masks of its halves, one bit left out."""
    choice = None
    for start in range(0, 64, width):
        field = F.lit(signed(((1 << width) - 1) << start))
        half = width // 2
        more = [m for h in (start, start + half) for m in one_wildcard(h, half)]
        masks = F.array(*[F.lit(signed(m)) for m in more])
        free = F.col("mask").bitwiseAND(field) == 0
        choice = F.when(free, masks) if choice is None else choice.when(free, masks)
    return choice


def keyed(rows: DataFrame) -> DataFrame:
    key = F.xxhash64("mask", F.col("mask").bitwiseAND(F.col("fp")))
    return rows.select("fp", "mask", key.alias("key"))


def shared(rows: DataFrame) -> DataFrame:
    """Rows whose key some other row has too, with the number of rows of the key."""
    sizes = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    return rows.join(sizes, "key")


def distance(many: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Differing bits; a row of several fingerprints counts all of them."""
    found = np.bitwise_count(many ^ one)
    return found if found.ndim == 1 else found.sum(1)


def spanning(fps: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links that connect the fingerprints of one bucket as all pairs within `bits` would.

    All members of a component hang on its first one, so that the buckets of a group that share
    most of their members give the same few links.
    """
    left, links = np.arange(1, len(fps)), []
    first, queue = 0, [0]
    while len(left):
        if not queue:
            first = int(left[0])
            queue.append(first)
            left = left[1:]
        at = queue.pop()
        near = distance(fps[left], fps[at]) <= bits
        links += [(first, int(x)) for x in left[near]]
        queue += left[near].tolist()
        left = left[~near]
    return links


def links(fps: DataFrame, bits: int = BITS, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links among the distinct fingerprints of the column fp that join all linked ones."""
    if bits != BITS:
        raise ValueError("two halves hold for three bits; other limits need other segments")
    masks = [F.lit(signed(m)) for start in (0, 32) for m in one_wildcard(start, 32)]
    rows = shared(keyed(fps.select("fp", F.explode(F.array(*masks)).alias("mask"))))
    for width in (32, 16):
        more = F.when(F.col("n") > bucket, finer(width)).otherwise(F.array(F.lit(0)))
        cut = rows.select("fp", "mask", F.explode(more).alias("more"))
        rows = shared(keyed(cut.select("fp", F.col("mask").bitwiseOR(F.col("more")).alias("mask"))))

    def batches(found):
        for batch in found:
            lists = batch.column(0)
            values = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            at = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
            size = np.diff(at)
            two = at[:-1][size == 2]
            near = np.bitwise_count(values[two] ^ values[two + 1]) <= bits
            out = [np.stack([values[two[near]], values[two[near] + 1]], 1)]
            for i in np.flatnonzero(size > 2):
                own = np.sort(values[at[i] : at[i + 1]])
                pairs = spanning(own, bits)
                if pairs:
                    out.append(own[np.array(pairs)])
            pairs = np.unique(np.concatenate(out), axis=0).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"]
            )

    lists = rows.groupBy("key").agg(F.collect_list("fp").alias("fps")).select("fps")
    return lists.mapInArrow(batches, "a long, b long")


def near_duplicates(docs: DataFrame, words: int) -> DataFrame:
    """(id, fp, component): the fingerprint of each row and the smallest id reachable by links."""
    rows = stored(fingerprints(docs, words))
    nodes = stored(rows.groupBy("fp").agg(F.min("id").alias("first")))
    roots = components(links(nodes))
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = named.groupBy("root").agg(F.min("first").alias("component"))
    of = named.join(smallest, "root").select("fp", "component")
    return rows.join(of, "fp").select("id", "fp", "component")


def query(docs: DataFrame) -> DataFrame:
    """The digest of the contract: three words, three bits."""
    found = near_duplicates(docs, words=3)
    return found.select(
        F.nullif("id", F.lit(NO_ID)).alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.nullif("component", F.lit(NO_ID)).alias("component_id"),
    )


def digests(text: str | None, words: int):
    """Two 128-bit hashes of each shingle of the whole text, 32 bytes a row, in chunks."""
    parts = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not parts:
        return
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(parts) - words + 1)
    first, last = starts[:n].tolist(), ends[min(words, len(parts)) - 1 :].tolist()
    digest = xxhash.xxh3_128_digest
    for k in range(0, n, CHUNK):
        shingles = [joined[i:j] for i, j in zip(first[k : k + CHUNK], last[k : k + CHUNK])]
        halves = [b"".join([digest(x, SEED + half) for x in shingles]) for half in (0, 1)]
        yield np.concatenate([np.frombuffer(raw, np.uint8).reshape(-1, 16) for raw in halves], axis=1)


def wide_described(text: str | None, words: int) -> tuple[np.ndarray, np.ndarray]:
    """`WIDTH` longs of two segments each, and the sorted 64-bit hashes of the set of shingles."""
    counts, n, own = np.zeros(32 * 256, np.int64), 0, []
    for raw in digests(text, words):
        n += len(raw)
        own.append(np.unique(np.ascontiguousarray(raw[:, :8]).view("<u8").ravel()))
        counts += np.bincount((raw + np.arange(0, 32 * 256, 256)).ravel(), minlength=32 * 256)
    if not n:
        return np.zeros(WIDTH, np.uint64), np.zeros(0, np.uint64)
    ones = counts.reshape(32, 256) @ np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
    found = (ones.ravel() * 2 > n)[: WIDTH * 2 * SEGMENT].reshape(WIDTH, 2 * SEGMENT)
    bits = np.zeros((WIDTH, 64), np.uint8)
    bits[:, : 2 * SEGMENT] = found
    shingles = own[0] if len(own) == 1 else np.unique(np.concatenate(own))
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel(), shingles


def wide_fingerprint(text: str | None, words: int) -> np.ndarray:
    return wide_described(text, words)[0]


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The sorted set of hashes that `wide_described` gives, without the fingerprint."""
    own = [np.unique(np.ascontiguousarray(raw[:, :8]).view("<u8").ravel()) for raw in digests(text, words)]
    return np.unique(np.concatenate(own)) if own else np.zeros(0, np.uint64)


def node_of(shingles: np.ndarray) -> int:
    return signed(xxhash.xxh3_64_intdigest(shingles.tobytes(), SEED))


def wide_fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """(id, f) of every row; f holds the bits of `wide_fingerprint`."""

    def batches(found):
        for batch in found:
            rows = [wide_fingerprint(x, words) for x in batch.column(1).to_pylist()]
            fps = (np.concatenate(rows) if rows else np.zeros(0, np.uint64)).view(np.int64)
            lists = pa.ListArray.from_arrays(np.arange(0, len(fps) + 1, WIDTH, dtype=np.int32), pa.array(fps))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["id", "f"])

    rows = docs.select(row_id().alias("id"), F.col("text").cast("string"))
    return rows.mapInArrow(batches, "id long, f array<long>")


def wide_bits(similarity: float) -> int:
    """Differing bits of all fingerprints that sets of this similarity have, plus one standard deviation."""
    share = np.arccos(2 * similarity / (1 + similarity)) / np.pi
    n = 2 * SEGMENT * WIDTH
    return int(n * share + np.sqrt(n * share * (1 - share)))


def grouped(rows: DataFrame, nodes: DataFrame, bucket: int) -> DataFrame:
    """(own): the members of each key of rows (node, key, n), n the size of the key, with the columns of nodes.

    A larger key is cut into blocks and each pair of blocks is a group of its own.
    """
    blocks = F.ceil(F.col("n") / bucket).cast("int")
    cut = rows.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1))
    )
    full = cut.join(nodes, "node")
    groups = full.groupBy("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    columns = [c for c in full.columns if c not in ("key", "n", "block", "other")]
    return groups.agg(F.collect_list(F.struct(*columns)).alias("own")).select("own")


def crossing(f: np.ndarray, side: np.ndarray, bits: int) -> np.ndarray:
    """Links that connect the fingerprints of one bucket as all pairs would if those of each side are joined elsewhere.

    They hang the smaller side, and those parts of the larger side that only the smaller one joins, on the first
    of the larger side.
    """

    def firsts(own):
        first = np.arange(len(own))
        for a, b in spanning(own, bits):
            first[b] = a
        return first

    larger, smaller = np.flatnonzero(side), np.flatnonzero(side == 0)
    if len(larger) < len(smaller):
        larger, smaller = smaller, larger
    group = firsts(f)
    groups, at = np.unique(group[larger], return_index=True)
    ends = np.concatenate((smaller, larger[np.unique(firsts(f[larger]))]))
    place = np.minimum(np.searchsorted(groups, group[ends]), len(groups) - 1)
    first = larger[at[place]]
    ok = (groups[place] == group[ends]) & (first != ends)
    return np.stack([first[ok], ends[ok]], 1)


def wide_links(nodes: DataFrame, bits: int, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links among nodes (node, f) that connect all linked ones that share a key.

    A key leaves one bit of a segment out, so its nodes have one or two values of the segment. The first key of a
    segment gives the links inside each value; the other keys give only those between their two values, and none
    if all nodes have one. So a node is in few links, however many keys it shares. A key that more than `bucket`
    nodes share is cut into blocks which all hold its first node; the prefixes find what that leaves apart.
    """
    masks = [m for start in (0, SEGMENT) for m in one_wildcard(start, SEGMENT)]
    keys = [
        F.xxhash64(F.lit(i), F.lit(signed(m)), F.get("f", F.lit(i)).bitwiseAND(F.lit(signed(m))))
        for i in range(WIDTH)
        for m in masks
    ]
    spread = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    made = nodes.repartition(spread).select("node", "f", F.posexplode(F.array(*keys)).alias("at", "key"))
    left_out = F.getbit(F.get("f", F.expr(f"at div {len(masks)}").cast("int")), F.col("at") % len(masks))
    side = F.when(F.col("at") % SEGMENT == 0, F.lit(WHOLE)).otherwise(left_out).cast("byte").alias("side")
    rows = made.select("node", "key", side).repartition("key")
    measures = F.count("*").alias("n"), F.min("node").alias("hub"), F.min("side").alias("lo"), F.max("side").alias("hi")
    sizes = rows.groupBy("key").agg(*measures).where((F.col("n") > 1) & ((F.col("lo") == WHOLE) | (F.col("lo") < F.col("hi"))))
    blocks = F.ceil(F.col("n") / bucket).cast("int")
    of = F.when(F.col("node") == F.col("hub"), F.sequence(F.lit(0), blocks - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("node"), blocks).cast("int"))
    )
    cut = rows.join(sizes, "key").select("key", "node", "side", F.explode(of).alias("block"))
    own = F.collect_list(F.struct("node", "side", "f")).alias("own")
    lists = cut.join(nodes.select("node", "f"), "node").groupBy("key", "block").agg(own).select("own")

    def batches(found):
        for batch in found:
            own = batch.column(0)
            rows = own.flatten()
            node = rows.field("node").to_numpy(zero_copy_only=False)
            side = rows.field("side").to_numpy(zero_copy_only=False)
            f = rows.field("f").flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, WIDTH)
            at = np.concatenate(([0], np.cumsum(own.value_lengths().to_numpy())))
            size = np.diff(at)
            two = at[:-1][size == 2]
            near = (np.bitwise_count(f[two] ^ f[two + 1]).sum(1) <= bits) & ((side[two] == WHOLE) | (side[two] != side[two + 1]))
            out = [np.stack([node[two[near]], node[two[near] + 1]], 1)]
            for i in np.flatnonzero(size > 2):
                order = at[i] + np.argsort(node[at[i] : at[i + 1]])
                if side[order[0]] == WHOLE:
                    pairs = np.array(spanning(f[order], bits), np.int64).reshape(-1, 2)
                else:
                    pairs = crossing(f[order], side[order], bits)
                out.append(node[order][pairs])
            pairs = np.unique(np.sort(np.concatenate(out), axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return lists.mapInArrow(batches, "a long, b long")


def least_shared(sizes, similarity: float):
    """Shingles that two sets of these sizes together share at least when they are similar."""
    return np.ceil(sizes * (similarity / (1 + similarity)) - 1e-9).astype(np.int64)


def common_shingles(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of several sampled documents, sorted, and how many; they only set the order of the prefixes."""
    share = max(1, docs.count() // SAMPLE)

    def batches(found):
        for batch in found:
            sets = [shingle_set(x, words) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64))], names=["s"])

    text = F.col("text").cast("string")
    picked = docs.select(text.alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0)
    counts = picked.mapInArrow(batches, "s long").groupBy("s").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON)
    rows = sorted((r["s"] % 2**64, r["n"]) for r in counts.orderBy(F.desc("n"), "s").limit(COMMON_KEPT).collect())
    return np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows], np.int64)


def sketch(shingles: np.ndarray) -> bytes:
    """Whether an odd number of shingles falls on each bit: two sets differ in no fewer shingles than these bits."""
    at = (shingles & np.uint64(SKETCH - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=SKETCH) & 1).tobytes()


def sketches(column) -> np.ndarray:
    """A row of longs for each sketch of an Arrow column."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, SKETCH // 64)


def most_apart(both: np.ndarray, similarity: float) -> np.ndarray:
    """Shingles in which similar sets of these sizes together differ at most."""
    return both - 2 * least_shared(both, similarity)


def described(docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """(id, h, node, size, f, sketch, keys) of every row; rows of equal shingle sets have the same node.

    h is a hash of the text: rows of one id may have different texts.

    keys is the prefix of the set: in one order of all shingles, similar sets share one of their first
    size - ceil(similarity * size) + 1. Common shingles come last in that order.
    """
    common, often = common_shingles(docs, words)

    def one(text):
        f, shingles = wide_described(text, words)
        n = len(shingles)
        keys = shingles
        if n and len(common):
            at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
            keys = shingles[np.lexsort((shingles, np.where(common[at] == shingles, often[at], 0)))]
        keys = keys[: n - int(np.ceil(similarity * n - 1e-9)) + 1]
        return node_of(shingles), n, f.view(np.int64), sketch(shingles), keys.copy().view(np.int64)

    def batches(found):
        for batch in sliced(found):
            rows = [one(x) for x in batch.column(2).to_pylist()]
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64()))
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            names = ["id", "h", "node", "size", "f", "sketch", "keys"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], names=names)

    text = F.col("text").cast("string")
    rows = docs.select(row_id().alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))
    columns = "id long, h long, node long, size long, f array<long>, sketch binary, keys array<long>"
    return rows.mapInArrow(batches, columns)


def open_keys(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows (node, key, at) of keys whose nodes (node, size, root) have several roots, with size and root."""
    own = rows.join(nodes.select("node", "size", "root"), "node")
    roots = own.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
    return own.join(roots.select("key"), "key").select("node", "key", "at", "size", "root")


def hub_pairs(rows: DataFrame, similarity: float, round_: int) -> DataFrame:
    """(a, b): of each key of rows (node, key, at, size, root) one node, the same in keys that share their nodes,
    with all nodes of other roots that may be similar to it: no more pairs than rows."""
    place = F.xxhash64("node", F.lit(round_))
    hubs = rows.groupBy("key").agg(F.min(F.struct(place.alias("place"), "node", "at", "size", "root")).alias("hub"))
    size, hub = F.col("size"), F.col("hub.size")
    most = F.least(size - F.col("at"), hub - F.col("hub.at"))
    least = F.ceil((size + hub) * (similarity / (1 + similarity)) - 1e-9)
    met = rows.join(hubs, "key").where((F.col("root") != F.col("hub.root")) & (most >= least))
    return met.select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct()


def prefix_pairs(rows: DataFrame, nodes: DataFrame, similarity: float, bucket: int = BUCKET) -> DataFrame:
    """(a, b): all pairs of nodes (node, size, root, perhaps sketch) of other roots that rows (node, key, at) leave possible.

    Sizes, places in the prefix and sketches are compared inside a key, before a pair is written.
    """
    several = open_keys(rows, nodes).select("node", "key", "at")
    sizes = several.groupBy("key").agg(F.count("*").alias("n"))
    lists = grouped(several.join(sizes, "key"), nodes, bucket)
    sketched = "sketch" in nodes.columns

    def batches(found):
        def table(out):
            pairs = np.unique(np.concatenate([*out, np.zeros((0, 2), np.int64)]), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in found:
            own = batch.column(0)
            flat = own.flatten()
            node, at, size, root = (
                flat.field(c).to_numpy(zero_copy_only=False) for c in ("node", "at", "size", "root")
            )
            if sketched:
                marks = sketches(flat.field("sketch"))
            ends = np.concatenate(([0], np.cumsum(own.value_lengths().to_numpy())))
            out, held = [], 0
            for first, last in zip(ends[:-1], ends[1:]):
                for x in range(first, last - 1):
                    y = np.arange(x + 1, last)
                    least = least_shared(size[x] + size[y], similarity)
                    ok = (root[x] != root[y]) & (np.minimum(size[x] - at[x], size[y] - at[y]) >= least)
                    y = y[ok]
                    if sketched and len(y):
                        y = y[distance(marks[y], marks[x]) <= most_apart(size[x] + size[y], similarity)]
                    if len(y):
                        out.append(np.sort(np.stack([np.full(len(y), node[x]), node[y]], 1), axis=1))
                        held += len(y)
                if held > HELD_PAIRS:
                    yield table(out)
                    out, held = [], 0
            yield table(out)

    return lists.mapInArrow(batches, "a long, b long").distinct()


def sliced(found):
    """The batches in slices of at most `ROWS` rows."""
    for batch in found:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def parts(column) -> list[np.ndarray]:
    """The lists of an Arrow column of longs."""
    ends = np.cumsum(column.value_lengths().to_numpy())
    return np.split(column.flatten().to_numpy(), ends[:-1]) if len(ends) else []


def similar(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes (node, first, size, sketch) whose shingle sets are similar, by the sets."""
    side = lambda c: nodes.select(F.col("node").alias(c), F.col("size").alias(f"{c}_size"), F.col("sketch").alias(f"{c}_sketch"))

    def near(found):
        for batch in found:
            a, b, m, x, n, y = (batch.column(c) for c in ("a", "b", "a_size", "a_sketch", "b_size", "b_sketch"))
            apart = distance(sketches(x), sketches(y))
            ok = pa.array(apart <= most_apart(m.to_numpy() + n.to_numpy(), similarity))
            yield pa.RecordBatch.from_arrays([a.filter(ok), b.filter(ok)], names=["a", "b"])

    left = stored(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(near, "a long, b long"))
    ends = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    needed = stored(nodes.select("node", "first").join(ends, "node"))
    # a row of another document that falls on a set bit costs time only; the join below drops it
    bit = F.pmod(F.xxhash64("first"), F.lit(FILTER)).cast("int").alias("bit")
    mask = F.bit_or(F.expr("shiftleft(1L, bit % 64)")).alias("mask")
    told = np.zeros(FILTER // 64, np.int64)
    for r in needed.select(bit).groupBy(F.expr("bit div 64").alias("word")).agg(mask).collect():
        told[r["word"]] = r["mask"]

    def sets(found):
        for batch in sliced(found):
            at = batch.column(2).to_numpy()
            batch = batch.filter(pa.array((told[at >> 6] >> (at & 63) & 1).astype(bool)))
            own = [shingle_set(x, words) for x in batch.column(1).to_pylist()]
            columns = [pa.array([node_of(x) for x in own], pa.int64()), pa.array([x.view(np.int64) for x in own], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["first", "node", "own"])

    rows = docs.select(row_id().alias("first"), F.col("text").cast("string").alias("text"), bit)
    found = rows.mapInArrow(sets, "first long, node long, own array<long>").join(needed, ["node", "first"])
    own = stored(found.groupBy("node").agg(F.any_value("own").alias("own")))

    def compare(found):
        for batch in sliced(found):
            ok = []
            for x, y in zip(parts(batch.column("x")), parts(batch.column("y"))):
                shared_ = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(shared_ >= similarity * (len(x) + len(y) - shared_) - 1e-9)
            ok = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(ok), batch.column("b").filter(ok)], names=["a", "b"])

    first = left.join(own.select(F.col("node").alias("a"), F.col("own").alias("x")), "a")
    full = first.join(own.select(F.col("node").alias("b"), F.col("own").alias("y")), "b")
    return full.mapInArrow(compare, "a long, b long")


def rooted(nodes: DataFrame, links: DataFrame) -> DataFrame:
    return nodes.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))


def near_groups(docs: DataFrame, words: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(id, h, node) of every row and (node, root) of every node: nodes of one root are linked by similar texts."""
    found = stored(described(docs, words, similarity))
    picked = [F.any_value(c).alias(c) for c in ("size", "f", "sketch", "keys")]
    nodes = stored(found.groupBy("node").agg(F.min("id").alias("first"), *picked))
    rows = stored(found.select("id", "h", "node"))
    dropped(found)
    keys = nodes.select("node", F.posexplode("keys").alias("at", "key"))
    prefixes = stored(shared(keys.repartition("key")).select("node", "key", "at"))
    # a set that shares no key of its prefix has no near copy
    live = nodes.join(prefixes.select("node").distinct(), "node", "left_semi")
    links_ = stored(similar(wide_links(live, wide_bits(similarity)).distinct(), nodes, docs, words, similarity))
    named = stored(rooted(nodes.select("node", "size", "sketch"), links_))
    for round_ in range(ROUNDS):
        rest = stored(open_keys(prefixes, named))
        if rest.isEmpty():  # all that share a key are linked, so no pair is left to compare
            return rows, named.select("node", "root")
        pairs = stored(hub_pairs(rest, similarity, round_))
        prefixes = rest.select("node", "key", "at")
        if pairs.isEmpty():
            break
        links_ = stored(links_.union(similar(pairs, nodes, docs, words, similarity)))
        named = stored(rooted(nodes.select("node", "size", "sketch"), links_))
    more = prefix_pairs(prefixes, named, similarity)
    links_ = links_.union(similar(more, nodes, docs, words, similarity))
    return rows, rooted(nodes.select("node"), links_)


def near_copies(docs: DataFrame, words: int = 5, similarity: float = SIMILARITY) -> DataFrame:
    """(id, component): the smallest id reachable by links between similar texts, for every row."""
    rows, roots = near_groups(docs, words, similarity)
    of = stored(rows.join(roots, "node").select("id", "root"))
    smallest = of.groupBy("root").agg(F.min("id").alias("component"))
    return of.join(smallest, "root").select("id", "component")


def keep_first(docs: DataFrame, words: int = 5) -> DataFrame:
    """One row of each group of similar texts stays: the one with the smallest doc_id (null last; of several texts
    with that doc_id the one of the smallest hash). Of rows that are equal in doc_id and text any one stays."""
    rows, roots = near_groups(docs, words, SIMILARITY)
    own = rows.groupBy("id", "h", "node").agg(F.count("*").alias("n"))
    place = F.struct((F.col("id") == NO_ID).alias("none"), "id", "h")
    of = stored(own.join(roots, "node").select("id", "h", "n", "root", place.alias("place")))
    best = of.groupBy("root").agg(F.min("place").alias("best"))
    told = of.join(best, "root").withColumn("stays", F.col("place") == F.col("best"))
    # rows that go, and those of which one of several stays
    gone = stored(told.where("NOT stays OR n > 1").select("id", "h", "stays"))
    full = docs.select(row_id().alias("id"), F.xxhash64(F.col("text").cast("string")).alias("h"), F.struct("*").alias("doc"))
    once = full.join(gone, ["id", "h"], "left_anti").select("doc.*")
    copies = full.join(gone.where("stays"), ["id", "h"]).groupBy("id", "h").agg(F.any_value("doc").alias("doc"))
    return once.union(copies.select("doc.*"))
