"""Removal of repeated passages by suffix arrays in a logarithmic family of levels.

A byte goes if a string of `LENGTH` bytes over it also starts earlier: in a document of smaller id, or
earlier in the same one. A suffix array over every byte of a large corpus is many times the corpus, so only
suffixes that can match are indexed:

1. Each window of `LENGTH` bytes has a key, the least hash of the `GRAM`-byte strings inside of it. Equal windows
   have equal keys. Neighbouring windows mostly share one, so a text is cut into runs of windows with
   one key, a few for each hundred bytes; the text of a run has a hash.
2. Runs are dealt out by key, sorted and streamed. Of runs with the same text all but the first repeat. A key with
   one run text only and no repetition inside of it needs no index. The first run of every other text is contested.
3. The text of contested runs goes to its key's index family. There, batches in order of position get suffix arrays:
   their windows' suffixes, sorted. A batch is scanned against itself and the existing levels; a suffix found
   there starts earlier. What is new becomes a level, and levels of equal size are merged, so there are
   logarithmically many.
4. Repeating runs and repeating windows are put together by document and cut out of its text.

Memory is bounded: runs are streamed with one row held back, an index family is dropped when its keys are
done, and a key with more than `SHARE` contested runs is split by the content of its windows (a window
that repeats inside of a batch of rows is sent once), so one passage in a third of all documents is spread over
tasks. Texts are shuffled once, by document.

Defined cases: null text is empty; texts below `LENGTH` bytes keep all; a null id is smaller than all others. A
document is an id and a text, told apart by a 64-bit hash of the text: rows equal in both are one document and do not
repeat each other; different texts of one id, or without an id, are documents of their own, in the order of
their hashes. Matches never cross documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import NO_ID, row_id, stored

LENGTH = 100
GRAM = 40
#: Most windows of a run; contested runs of a key in one index family; runs of a batch; runs until keys are dropped.
RUN = 64
SHARE = 512
BATCH = 512
FAMILY = 4096
#: Bytes of text hashed at once.
PART = 2_000_000
ODD = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """A hash of every GRAM-byte string, of its words of eight bytes."""
    n = len(text) - GRAM + 1
    words = np.ndarray((len(text) - 7,), "<u8", text.tobytes(), strides=(1,))
    out = np.zeros(n, np.uint64)
    for at in range(0, GRAM, 8):
        out ^= words[at : at + n]
        out *= ODD
        out ^= out >> np.uint64(29)
    return out


def sliding(values: np.ndarray, width: int, fold) -> np.ndarray:
    """fold over every `width` neighbours, by doubling."""
    out, done = values, 1
    while done * 2 <= width:
        out, done = fold(out[:-done], out[done:]), done * 2
    return fold(out[: len(values) - width + 1], out[width - done :]) if done < width else out


def runs(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(start, windows, key, hash of the text, whether a window may repeat inside) of the runs of texts put together.

    `ends` holds where each text ends.
    """
    starts = np.concatenate(([0], ends[:-1]))
    last = ends - LENGTH + 1  # behind the last window of a text
    able = last > starts
    if not able.any():
        empty = np.zeros(0, np.int64)
        return empty, empty, empty.view(np.uint64), empty.view(np.uint64), empty.astype(bool)
    wide = LENGTH - GRAM + 1
    grams = gram_hashes(text)
    least = sliding(grams, wide, np.minimum)
    changes = np.flatnonzero(least[1:] != least[:-1]) + 1
    bounds = np.unique(np.concatenate((changes, starts[able], last[able])))
    begin = bounds[:-1]
    of = np.searchsorted(starts[able], begin, "right") - 1
    inside = (of >= 0) & (begin < last[able][of])
    begin, size = begin[inside], (bounds[1:] - bounds[:-1])[inside]
    pieces = -(-size // RUN)
    piece = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    size = np.minimum(np.repeat(size, pieces) - piece * RUN, RUN)
    begin = np.repeat(begin, pieces) + piece * RUN
    key = least[begin]
    final = begin + size - 1 + wide - 1  # the last gram of a run
    told = grams[begin] * ODD + size.astype(np.uint64)
    for at in range(GRAM, RUN + LENGTH, GRAM):
        told ^= told >> np.uint64(31)
        told = told * ODD + grams[np.minimum(begin + at, final)]
    pad = np.zeros(wide - 1, np.uint64)
    anchors = np.flatnonzero(grams == sliding(np.concatenate((pad, least, pad)), wide, np.maximum))
    same = np.concatenate(([0], np.cumsum(grams[anchors[1:]] == grams[anchors[:-1]])))
    low, high = np.searchsorted(anchors, begin), np.searchsorted(anchors, final, "right")
    return begin, size, key, told, same[high - 1] > same[low]


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts put together, and where each ends."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], (offsets[1:] - offsets[0]).astype(np.int64)


def parts(batches, column: int):
    """The batches in pieces of about `PART` bytes of text, at least a row each."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // PART
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(part)]))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if b > a:
                yield batch.slice(a, b - a)


def sections(text: np.ndarray, ends: np.ndarray):
    """(text, ends, place in the text): as given, or one very long text cut between windows."""
    if len(ends) > 1 or len(text) <= 2 * PART:
        yield text, ends, 0
        return
    for at in range(0, len(text) - LENGTH + 1, PART):
        part = text[at : at + PART + LENGTH - 1]
        yield part, np.array([len(part)]), at


def run_rows(texts: DataFrame) -> DataFrame:
    """key, told, id, h, start, n of every run; n is 1,000 more where a window may repeat inside."""

    def batches(found):
        for batch in parts(found, 1):
            ids, hashes = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            whole, whole_ends = texts_of(batch.column(1))
            for text, ends, shift in sections(whole, whole_ends):
                begin, size, key, told, twice = runs(text, ends)
                of = np.searchsorted(ends, begin, "right")
                start = begin - np.concatenate(([0], ends[:-1]))[of] + shift
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key.view(np.int64)),
                        pa.array(told.view(np.int64)),
                        pa.array(ids[of]),
                        pa.array(hashes[of]),
                        pa.array(start),
                        pa.array((size + 1000 * twice).astype(np.int32)),
                    ],
                    names=["key", "told", "id", "h", "start", "n"],
                )

    return texts.mapInArrow(batches, "key long, told long, id long, h long, start long, n int")


def marked(rows: DataFrame) -> DataFrame:
    """key, id, h, start, n, repeats of the runs that repeat another one or are contested."""

    def batches(found):
        held = None  # the last first run of a text, as a batch of one row, and whether its key has had another
        for batch in found:
            if not batch.num_rows:
                continue
            lone = held is not None
            if lone:
                batch = pa.Table.from_batches([held[0], batch]).combine_chunks().to_batches()[0]
            key, told, id_, h, start, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            new_key = np.concatenate(([True], key[1:] != key[:-1]))
            first = new_key | np.concatenate(([True], told[1:] != told[:-1]))
            at = np.flatnonzero(first)
            others = ~new_key[at]
            if lone:
                others[0] = held[1]
            more = others.copy()
            more[:-1] |= ~new_key[at[1:]]
            more |= n[at] > 1000
            held = (batch.slice(int(at[-1]), 1), bool(others[-1]))
            contested = at[:-1][more[:-1]]
            # the same place again is a repeated row, not a repeated text
            origin = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
            later = (id_ != id_[origin]) | (h != h[origin]) | (start != start[origin])
            yield from told_rows(batch, np.flatnonzero(later), True)
            yield from told_rows(batch, contested, False)
        if held is not None and (held[1] or held[0].column(5)[0].as_py() > 1000):
            yield from told_rows(held[0], np.array([0]), False)

    dealt = rows.repartition("key").sortWithinPartitions("key", "told", "id", "h", "start")
    return dealt.mapInArrow(batches, "key long, id long, h long, start long, n int, repeats boolean")


def told_rows(batch: pa.RecordBatch, at: np.ndarray, repeats: bool):
    if len(at):
        rows = batch.take(pa.array(at))
        n = pa.array(rows.column(5).to_numpy(zero_copy_only=False) % 1000, pa.int32())
        arrays = [*(rows.column(i) for i in (0, 2, 3, 4)), n, pa.array(np.full(len(at), repeats))]
        yield pa.RecordBatch.from_arrays(arrays, names=["key", "id", "h", "start", "n", "repeats"])


SLICES = "key long, shard int, id long, h long, start long, n int, slice binary"


def slices(texts: DataFrame, contested: DataFrame) -> DataFrame:
    """The text of every contested run; of a split key the text of every window, by its content."""
    sizes = contested.groupBy("key").agg(F.count("*").alias("m")).where(F.col("m") > SHARE)
    shards = F.coalesce(F.ceil(F.col("m") / SHARE), F.lit(0)).cast("int")
    told = contested.join(sizes, "key", "left").withColumn("shards", shards)
    lists = told.groupBy("id", "h").agg(F.collect_list(F.struct("key", "shards", "start", "n")).alias("own"))

    def batches(found):
        for batch in found:
            out, seen = [], {}
            for id_, h, text, own in zip(*(batch.column(i) for i in range(4))):
                id_, h, text = id_.as_py(), h.as_py(), text.as_buffer().to_pybytes()
                for run in sorted(own.as_py(), key=lambda x: x["start"]):
                    key, shards, start, n = run["key"], run["shards"], run["start"], run["n"]
                    n = min(n, len(text) - LENGTH - start + 1)
                    if n < 1:
                        continue
                    if not shards:
                        out.append((key, 0, id_, h, start, n, text[start : start + n + LENGTH - 1]))
                        continue
                    known = 0  # windows of the same content that this task has sent from an earlier place
                    for at in range(start, start + n):
                        window = text[at : at + LENGTH]
                        told = xxhash.xxh3_128_intdigest(window)
                        if seen.get(told, (id_, h, at)) < (id_, h, at):
                            known += 1
                            continue
                        seen[told] = (id_, h, at)
                        if known:
                            out.append((key, 0, id_, h, at - known, known, None))
                            known = 0
                        out.append((key, 1 + told % shards, id_, h, at, 1, window))
                    if known:
                        out.append((key, 0, id_, h, start + n - known, known, None))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out) if out else [()] * 7, SLICE_TYPES)],
                names=["key", "shard", "id", "h", "start", "n", "slice"],
            )

    return texts.join(lists, ["id", "h"]).select("id", "h", "text", "own").mapInArrow(batches, SLICES)


SLICE_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]


class Levels:
    """Sorted suffixes in levels whose sizes are batches times powers of two."""

    def __init__(self):
        self.levels: list[tuple[int, np.ndarray]] = []

    def add(self, suffixes: np.ndarray) -> np.ndarray:
        """Index a batch, given in order of position; whether each suffix was there before."""
        order = np.argsort(suffixes, kind="stable")
        array = suffixes[order]
        before = np.concatenate(([False], array[1:] == array[:-1]))
        for _, level in self.levels:
            at = np.minimum(np.searchsorted(level, array), len(level) - 1)
            before |= level[at] == array
        new, size = array[~before], 1
        while self.levels and self.levels[-1][0] <= size:
            size += self.levels[-1][0]
            new = np.sort(np.concatenate((self.levels.pop()[1], new)), kind="stable")
        if len(new):
            self.levels.append((size, new))
        out = np.empty(len(order), bool)
        out[order] = before
        return out


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All windows of the texts as fixed strings, and how many each text has."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    n = sizes - LENGTH + 1
    flat = np.frombuffer(b"".join(texts), np.uint8)
    at = np.repeat(np.cumsum(sizes) - sizes - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    return np.ascontiguousarray(
        np.lib.stride_tricks.sliding_window_view(flat, LENGTH)[at]
    ).view(f"S{LENGTH}").ravel(), n


def repeated(rows: list[tuple]) -> list[tuple[int, int, int, int]]:
    """(id, h, start, n) of the repeating windows among the slices of whole keys."""
    rows = sorted(set(rows))  # repeated rows of a table are one text
    index, out = Levels(), []
    for i in range(0, len(rows), BATCH):
        own = rows[i : i + BATCH]
        suffixes, n = windows_of([x[3] for x in own])
        found = index.add(suffixes)
        ids, hashes = (np.repeat([x[i] for x in own], n) for i in (0, 1))
        at = np.arange(len(found)) - np.repeat(np.cumsum(n) - n, n)
        place = np.repeat([x[2] for x in own], n) + at
        edge = found & ~np.concatenate(([False], found[:-1] & (at[1:] > 0)))
        begin = np.flatnonzero(edge)
        size = np.add.reduceat(found, begin) if len(begin) else begin
        out += list(zip(*(x.tolist() for x in (ids[begin], hashes[begin], place[begin], size))))
    return out


def indexed(found: DataFrame) -> DataFrame:
    """id, h, start, n of the windows that an index family holds from an earlier place."""

    def told(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (zip(*rows) if rows else [()] * 4)], names=["id", "h", "start", "n"]
        )

    def batches(found_):
        own, last = [], None
        for batch in found_:
            known = []
            for key, shard, id_, h, start, n, text in zip(*(c.to_pylist() for c in batch.columns)):
                if text is None:
                    known.append((id_, h, start, n))
                    continue
                if (key, shard) != last and len(own) >= FAMILY:
                    yield told(repeated(own))
                    own = []
                last = (key, shard)
                own.append((id_, h, start, text))
            yield told(known)
        yield told(repeated(own))

    dealt = found.repartition("key", "shard").sortWithinPartitions("key", "shard")
    return dealt.mapInArrow(batches, "id long, h long, start long, n long")


def cut_spans(size: int, own: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The maximal removed runs of a text from (start, n) of its repeating windows."""
    out: list[tuple[int, int]] = []
    for start, n in sorted(own):
        end = min(size, start + n + LENGTH - 1)
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        elif end > start:
            out.append((start, end))
    return out


SPANS = "array<struct<start: long, end: long>>"


def deduplicate(docs: DataFrame) -> DataFrame:
    """id, n_bytes, spans (removed byte ranges) and kept (the remaining bytes) of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    texts = docs.select(row_id().alias("id"), text.alias("text"), F.xxhash64(text).alias("h"))
    marks = stored(marked(run_rows(texts)))
    within = indexed(slices(texts, marks.where("NOT repeats").drop("repeats")))
    whole = marks.where("repeats").select("id", "h", "start", F.col("n").cast("long"))
    lists = whole.union(within).groupBy("id", "h").agg(F.collect_list(F.struct("start", "n")).alias("own"))

    def batches(found):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in found:
            size, spans, kept = [], [], []
            for text, own in zip(batch.column(1), batch.column(2)):
                text, own = text.as_buffer().to_pybytes(), own.as_py() or []
                cut = cut_spans(len(text), [(x["start"], x["n"]) for x in own])
                edges = [0, *[x for span in cut for x in span], len(text)]
                size.append(len(text))
                spans.append([{"start": a, "end": b} for a, b in cut])
                kept.append(b"".join([text[a:b] for a, b in zip(edges[::2], edges[1::2])]))
            arrays = [batch.column(0), pa.array(size, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "n_bytes", "spans", "kept"])

    return texts.join(lists, ["id", "h"], "left").select("id", "text", "own").mapInArrow(
        batches, f"id long, n_bytes long, spans {SPANS}, kept binary"
    )


def query(docs: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return deduplicate(docs).select(
        F.nullif("id", F.lit(NO_ID)).alias("doc_id"),
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
