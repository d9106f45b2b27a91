"""Conversation prefix trie by truncation peeling.

A conversation is a path of turns. Equal conversations are merged first; the peeling then descends from the
greatest depth: conversations that end at a depth join the nodes that survived from below, one aggregate merges
them, the last turn is cut off and what is left meets at the next depth. A node is found and its sums over the
subtree are complete in the same step, so nothing is walked twice and no prefix is written out beforehand.

A path is the row of its turns' items, each the SHA-256 of role and text and the length of the text, so a node's
parent is a shorter piece of the same value. Each depth is one aggregate on the path with map-side sums: a first
turn that a third of all conversations share is merged before the shuffle. Every depth is stored in the shared
folder. The end of a path that no other distinct path shares holds one node a turn with known sums; it is laid out at
once, from the least power of two of turns that the path has for itself, so there are at most twice as many steps as
the longest shared beginning has turns, however long a conversation is. A path takes 40 bytes a turn.

The digest of the conversations that end at a node is a hash over all their ids in order. Ids are joined to text in
blocks of neighbouring ids by many tasks; only a node with several blocks is streamed, block by block, through one
hash, which SHA-256 leaves no other way for.

Defined cases: rows without conv_id belong to no conversation and are left out; a null role or text is empty; a null
turn comes first; rows of one turn number are ordered by the hash of role and text, and repeated rows stay repeated
turns; an empty table has no nodes, not even a root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import dropped, stored

#: Bytes of a turn in a path: 32 of the hash, 8 of the text's length.
ITEM = 40
#: Ids that differ only in their last bits are joined to one text.
BLOCK_BITS = 12
#: Conversations of a hundred share a head of at most `HEADS` - 1 turns.
HUNDRED = 100
HEADS = 6


def item(role: Column, text: Column) -> Column:
    """Hex digits that stand for a turn."""
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    turn = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.sha2(turn, 256), F.lpad(F.hex(F.char_length(text).cast("long")), 16, "0"))


def paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, path) of every conversation, its turns in order."""
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").cast("long").alias("turn"), item(F.col("role"), F.col("text")).alias("item")).alias("t"),
    ).where("conv_id IS NOT NULL")
    lists = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return lists.select("conv_id", F.unhex(F.array_join(F.col("t.item"), "")).alias("path"))


def cut(path: str, first: Column, length: Column) -> Column:
    """Turns of a path: `length` of them from number `first` (from 0)."""
    return F.substring(F.col(path), first * ITEM + 1, length * ITEM)


def rebuilt(found: DataFrame) -> DataFrame:
    """(conv_id, path): the head of each conversation replaced by the head of the first one of its hundred."""
    c = F.col("conv_id")
    h = F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(HEADS)).cast("int")
    own = found.select("conv_id", "path", h.alias("h"), (c - c % HUNDRED).alias("base"))
    firsts = found.where(c % HUNDRED == 0).select(
        F.col("conv_id").alias("base"), cut("path", F.lit(0), F.lit(HEADS - 1)).alias("head")
    )
    rest = F.length("path") / ITEM
    empty = F.lit(b"")
    head = F.coalesce(cut("head", F.lit(0), F.col("h")), empty)
    tail = F.when(rest > F.col("h"), cut("path", F.col("h"), rest.cast("int"))).otherwise(empty)
    return own.join(firsts, "base", "left").select("conv_id", F.concat(head, tail).alias("path"))


def ended(found: DataFrame) -> DataFrame:
    """(path, conv_id, n_convs, ends_sha256) of every distinct path: its smallest id, how many ids, their digest."""
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    blocks = stored(
        found.groupBy("path", F.shiftright("conv_id", BLOCK_BITS).alias("block")).agg(
            ids.alias("ids"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")
        )
    )
    merged = blocks.groupBy("path").agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.count("*").alias("n_blocks"),
        F.min("ids").alias("ids"),
    )

    def digests(batches):
        path, digest = None, None
        for batch in batches:
            done = []
            for p, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if p != path:
                    if digest:
                        done.append((path, digest.hexdigest()))
                    path, digest = p, hashlib.sha256(text.encode())
                else:
                    digest.update(b"," + text.encode())
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())],
                names=["path", "streamed"],
            )
        if digest:
            yield pa.RecordBatch.from_arrays(
                [pa.array([path], pa.binary()), pa.array([digest.hexdigest()])], names=["path", "streamed"]
            )

    several = blocks.join(merged.where("n_blocks > 1").select("path"), "path").select("path", "ids", "block")
    ordered = several.repartition("path").sortWithinPartitions("path", "block").select("path", "ids")
    streamed = ordered.mapInArrow(digests, "path binary, streamed string")
    alone = F.when(F.col("n_blocks") == 1, F.sha2(F.col("ids"), 256))
    return stored(
        merged.join(streamed, "path", "left").select(
            "path", "conv_id", "n_convs", F.coalesce(alone, "streamed").alias("ends_sha256")
        )
    )


def depth_of(path: str) -> Column:
    return (F.length(path) / ITEM).cast("int")


def code_points(path: str, turn: Column) -> Column:
    """Code points of the text of a turn (from 1)."""
    return F.conv(F.hex(F.substring(F.col(path), turn * ITEM - 7, F.lit(8))), 16, 10).cast("long")


def private_from(ends: DataFrame) -> DataFrame:
    """(conv_id, top): the least power of two from which on no other distinct path has the path's first turns."""
    powers = F.array(*[F.lit(1 << i) for i in range(31)])
    tops = F.filter(powers, lambda p: p <= depth_of("path"))
    keyed = ends.select("conv_id", "path", F.explode(tops).alias("top"))
    key = F.struct("top", F.unhex(F.sha2(cut("path", F.lit(0), F.col("top")), 256)).alias("sha"))
    owners = keyed.groupBy(key.alias("key")).agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"))
    return owners.where("n = 1").groupBy("conv_id").agg(F.min("key.top").alias("top"))


def trie(found: DataFrame) -> DataFrame:
    """The nodes of the prefix trie of (conv_id, path), one row each, with the columns of the contract."""
    distinct = ended(found)
    ends = stored(distinct.join(private_from(distinct), "conv_id", "left").withColumn("length", depth_of("path")))
    top = F.least(F.coalesce("top", "length"), F.col("length"))
    after = F.when(F.col("length") > F.col("top"), F.sequence(F.col("top") + 1, F.col("length")))
    # what a private end below `top` leaves of saved tokens; nothing unless several conversations are equal
    rest = F.when(
        F.col("n_convs") > 1,
        (F.col("n_convs") - 1)
        * F.aggregate(after, F.lit(0).cast("long"), lambda total, i: total + code_points("path", i)),
    )
    nothing = F.lit(0).cast("long")
    has_end = F.col("length") > F.col("top")
    new = stored(
        ends.withColumn("top", top).withColumn("saved", F.coalesce(rest, nothing)).select(
            cut("path", F.lit(0), F.col("top")).alias("path"), "conv_id", "n_convs",
            F.when(~has_end, F.col("ends_sha256")).alias("ends_sha256"),
            F.when(has_end, F.lit(1)).otherwise(0).cast("long").alias("children"),
            F.when(has_end, F.lit(1)).otherwise(0).cast("long").alias("leaves"),
            "saved",
        )
    )
    levels, below = [], None
    deepest = new.agg(F.max(depth_of("path"))).first()[0]
    for d in range(deepest if deepest is not None else -1, -1, -1):
        here = new.where(F.length("path") == d * ITEM)
        if below is not None:
            up = below.select(
                cut("path", F.lit(0), F.lit(d)).alias("path"), "conv_id", "n_convs",
                F.lit(None).cast("string").alias("ends_sha256"),
                F.lit(1).cast("long").alias("children"), F.col("n_leaves").alias("leaves"),
                F.col("saved_tokens").alias("saved"),
            )
            here = here.union(up)
        merged = here.groupBy("path").agg(
            F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
            F.sum("children").alias("n_children"), F.sum("leaves").alias("leaves"),
            F.sum("saved").alias("saved"), F.max("ends_sha256").alias("ends_sha256"),
        )
        own = (F.col("n_convs") - 1) * code_points("path", F.lit(d)) if d else nothing
        below = stored(
            merged.select(
                "path", "conv_id", F.lit(d).cast("long").alias("depth"), "n_convs", "n_children",
                F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.col("leaves")).cast("long").alias("n_leaves"),
                (F.col("saved") + own).alias("saved_tokens"), "ends_sha256",
            )
        )
        levels.append(below)
    dropped(distinct)
    dropped(new)
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]

    def named(nodes: DataFrame, parent: Column) -> DataFrame:
        of = nodes.withColumn("parent_conv_id", parent.cast("long"))
        return of.select(*columns, F.coalesce("ends_sha256", empty).alias("ends_sha256"))

    k, length = F.col("k"), F.col("length")
    tails = ends.withColumn("top", top).where(has_end).withColumn("k", F.explode(after)).select(
        "conv_id", k.cast("long").alias("depth"), F.col("conv_id").alias("parent"), "n_convs",
        F.when(k < length, F.lit(1)).otherwise(0).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.when(F.col("n_convs") == 1, nothing).otherwise(
            (F.col("n_convs") - 1)
            * F.aggregate(F.sequence(k, length), F.lit(0).cast("long"), lambda total, i: total + code_points("path", i))
        ).alias("saved_tokens"),
        F.when(k == length, F.col("ends_sha256")).alias("ends_sha256"),
    )
    out = named(tails, F.col("parent"))
    if not levels:
        return out
    # the root is one row and may have very many children: its id is a literal, the others meet on the path
    root = levels[-1].first()["conv_id"]
    out = out.union(named(levels[-1], F.lit(None)))
    if len(levels) > 1:
        out = out.union(named(levels[-2], F.lit(root)))
    if len(levels) > 2:
        below, above = (reduce(DataFrame.union, part) for part in (levels[:-2], levels[1:-1]))
        parents = above.where("n_children > 0").select(F.col("path").alias("up"), F.col("conv_id").alias("of"))
        parent = cut("path", F.lit(0), F.col("depth").cast("int") - 1)
        out = out.union(named(below.join(parents, parent == F.col("up")), F.col("of")))
    return out


def query(conversations: DataFrame) -> DataFrame:
    """The digest of the contract over rebuilt conversations."""
    return trie(stored(rebuilt(paths(conversations))))
