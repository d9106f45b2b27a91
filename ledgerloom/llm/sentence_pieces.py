"""SentencePiece encoding and decoding by suffix-array matching.

The pieces of a batch come from its distinct chunks (blanks and the characters up to the next blank; no
piece goes beyond). The chunks are put in one text, its suffixes are sorted, and every piece of the
vocabulary is looked up by binary search: the range of suffixes that start with it gives all its
occurrences. These edges, sorted by position, are then relaxed chunk by chunk: of the edges that join
two neighbouring pieces the best ranked is applied, leftmost first, until none is left. That is the merge order of
the vocabulary's own rule, so ids equal those of the reference encoder. Characters without
a piece become byte pieces.

One pass, no shuffle; memory is bounded by a batch of rows. The vocabulary is read on the driver from a
path parameter and travels with the tasks.

Defined cases: null gives null ids, empty text gives an empty list; decoding null gives null; a literal
U+2581 in a text is a blank to the vocabulary and decodes to one; bytes that are no UTF-8 decode to
U+FFFD. Other columns pass through; columns that
have the names of new ones are replaced.
"""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Stands between chunks in the batch text; no piece holds it.
BORDER = 0x10FFFF
#: Chunks longer than this are merged one by one with a heap.
LONG = 200
#: Bytes of text whose chunks share a suffix array; a longer text has one of its own.
PART = 2_000_000


@dataclass
class Vocabulary:
    pieces: list[str]
    ranks: list[float]
    plain: list[bool]
    byte_ids: list[int]

    def __post_init__(self):
        own = [(p, r, i) for i, (p, r) in enumerate(zip(self.pieces, self.ranks)) if self.plain[i]]
        self.words = [p.replace(SPACE, " ") for p, _, _ in own]
        #: By number of the word, from 1; 0 stands for no edge and comes after all.
        ranks = np.unique([r for _, r, _ in own], return_inverse=True)[1]
        self.rank_of = np.concatenate(([len(own) + 1], ranks)).astype(np.int32)
        self.word_ids = np.array([i for _, _, i in own], np.int32)
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.width = int(self.sizes.max())
        many = {c for p in self.words if len(p) > 1 for c in p}
        if any(" " in p.strip(" ") or p.endswith(" ") and p.strip(" ") for p in self.words):
            self.chunk = re.compile(r".+", re.DOTALL)  # a piece goes beyond a blank: keep texts whole
        elif "\n" in many:
            self.chunk = re.compile(r" +[^ ]*|[^ ]+")
        else:
            self.chunk = re.compile(r" +[^ \n]*|[^ \n]+|\n")


def load(path: str = MODEL) -> Vocabulary:
    """Pieces, ranks and byte pieces of a model file, read on the driver."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    plain = [not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i)) for i in ids]
    return Vocabulary(
        [model.id_to_piece(i) for i in ids],
        [-model.get_score(i) for i in ids],
        plain,
        [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)],
    )


class Numbers(dict):
    """Numbers distinct values in the order of their first use."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


def suffix_order(text: np.ndarray, letter: np.dtype, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of the batch text in order, compared up to `width` letters, and those heads."""
    padded = np.concatenate((text, np.zeros(width, text.dtype))).astype(letter)
    heads = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, width)[: len(text)])
    room = -(-width * letter.itemsize // 8) * 8
    raw = np.zeros((len(text), room), np.uint8)
    raw[:, : width * letter.itemsize] = heads.view(np.uint8).reshape(len(text), -1)
    keys = raw.view(">u8").astype(np.uint64)
    order = np.lexsort(keys.T[::-1])
    return order, raw[order].view(f"S{room}").ravel()


def edges(text: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(position, index of the piece) of every occurrence of every piece."""
    alphabet = np.unique(text)
    letter = np.dtype(">u1" if len(alphabet) < 255 else ">u2" if len(alphabet) < 65535 else ">u4")
    order, heads = suffix_order(np.searchsorted(alphabet, text) + 1, letter, vocabulary.width)
    number = {int(c): i + 1 for i, c in enumerate(alphabet)}
    here = [i for i, w in enumerate(vocabulary.words) if all(ord(c) in number for c in w)]
    words = [
        b"".join(number[ord(c)].to_bytes(letter.itemsize, "big") for c in vocabulary.words[i]) for i in here
    ]
    room = heads.dtype.itemsize
    low = np.searchsorted(heads, np.array(words, f"S{room}"), "left")
    high = np.searchsorted(heads, np.array([w.ljust(room, b"\xff") for w in words], f"S{room}"), "right")
    count = high - low
    piece = np.repeat(np.array(here, np.int64), count)
    begin = np.repeat(low - np.concatenate(([0], np.cumsum(count)[:-1])), count)
    return order[begin + np.arange(len(piece))], piece


def relaxed(size: int, rank_of) -> list[tuple[int, int]]:
    """The pieces' ranges in one long chunk after all merges; `rank_of(s, e)` is None without an edge."""
    after, before = list(range(1, size + 1)), list(range(-1, size))
    alive, heap = [True] * size, []

    def offer(s: int, e: int) -> None:
        rank = rank_of(s, e)
        if rank is not None:
            heapq.heappush(heap, (rank, s, e))

    for k in range(size - 1):
        offer(k, k + 2)
    while heap:
        _, s, e = heapq.heappop(heap)
        if not alive[s] or after[s] >= e or after[after[s]] != e:
            continue
        alive[after[s]], after[s] = False, e
        if e < size:
            before[e] = s
            offer(s, after[e])
        if s:
            offer(before[s], e)
    return [(s, after[s]) for s in range(size) if alive[s]]


def merged(starts: np.ndarray, size: int, table: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the pieces of all chunks of one size, a merge of every chunk at a time."""
    width = table.shape[1]
    bounds = starts[:, None] + np.arange(size + 1)
    begin, end = [], []
    while len(bounds):
        if bounds.shape[1] > 2:
            s, span = bounds[:, :-2], bounds[:, 2:] - bounds[:, :-2]
            rank = np.where(span <= width, ranks[table[s, np.minimum(span, width) - 1]], ranks[0])
            best = np.argmin(rank, axis=1)
            more = rank[np.arange(len(rank)), best] < ranks[0]
        else:
            best, more = np.zeros(len(bounds), np.int64), np.zeros(len(bounds), bool)
        begin.append(bounds[~more, :-1].ravel())
        end.append(bounds[~more, 1:].ravel())
        bounds, best = bounds[more], best[more]
        keep = np.arange(bounds.shape[1]) != (best + 1)[:, None]
        bounds = bounds[keep].reshape(len(bounds), keep.shape[1] - 1)
    return np.concatenate(begin), np.concatenate(end)


def encoded_chunks(chunks: list[str], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the distinct chunks, one after the other, and how many each has."""
    if not chunks:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    codes = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
    starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    text = np.full(int(sizes.sum()) + len(chunks), BORDER, np.uint32)
    text[np.arange(len(codes)) + np.repeat(np.arange(len(chunks)), sizes)] = codes
    at, piece = edges(text, vocabulary)
    table = np.zeros((len(text), vocabulary.width), np.uint16 if len(vocabulary.words) < 65535 else np.int32)
    table[at, vocabulary.sizes[piece] - 1] = piece + 1
    begin, end = [], []
    for size in np.unique(sizes).tolist():
        own = starts[sizes == size]
        if size <= LONG:
            s, e = merged(own, size, table, vocabulary.rank_of)
            begin.append(s), end.append(e)
            continue
        for base in own.tolist():

            def rank_of(s, e, base=base):
                found = table[base + s, e - s - 1] if e - s <= vocabulary.width else 0
                return vocabulary.rank_of[found] if found else None

            found = np.array(relaxed(size, rank_of)) + base
            begin.append(found[:, 0]), end.append(found[:, 1])
    begin, end = np.concatenate(begin), np.concatenate(end)
    order = np.argsort(begin)
    begin, end = begin[order], end[order]
    found = table[begin, np.minimum(end - begin, vocabulary.width) - 1]
    ids = vocabulary.word_ids[found.astype(np.int64) - 1]
    count = np.ones(len(begin), np.int64)
    unknown = np.flatnonzero(found == 0)
    spelled = {
        int(c): [vocabulary.byte_ids[x] for x in chr(c).encode("utf-8", "surrogatepass")]
        for c in np.unique(text[begin[unknown]])
    }
    spell = [spelled[c] for c in text[begin[unknown]].tolist()]
    count[unknown] = [len(x) for x in spell]
    flat = np.repeat(ids, count)
    first = np.concatenate(([0], np.cumsum(count)[:-1]))[unknown]
    if len(unknown):
        at = np.repeat(first, count[unknown]) + np.concatenate([np.arange(len(x)) for x in spell])
        flat[at] = [i for x in spell for i in x]
    owner = np.searchsorted(starts, begin, "right") - 1
    return flat.astype(np.int32), np.bincount(owner, count, len(chunks)).astype(np.int64)


def encoded(texts: list[str | None], vocabulary: Vocabulary) -> list[np.ndarray | None]:
    """The ids of each text of a batch."""
    numbers, rows = Numbers(), []
    for text in texts:
        if not text:
            rows.append(None if text is None else np.zeros(0, np.int64))
            continue
        found = vocabulary.chunk.findall(" " + text.replace(SPACE, " "))
        rows.append(np.array(list(map(numbers.__getitem__, found)), np.int64))
    flat, sizes = encoded_chunks(list(numbers), vocabulary)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    out = []
    for row in rows:
        if row is None or not len(row):
            out.append(None if row is None else np.zeros(0, np.int32))
            continue
        own = sizes[row]
        shift = np.repeat(starts[row] - np.concatenate(([0], np.cumsum(own)[:-1])), own)
        out.append(flat[shift + np.arange(int(own.sum()))])
    return out


def surfaces(vocabulary: Vocabulary) -> list[bytes]:
    """What each id writes."""
    byte = {i: bytes([b]) for b, i in enumerate(vocabulary.byte_ids)}
    return [
        byte.get(i, p.replace(SPACE, " ").encode() if vocabulary.plain[i] else b"")
        for i, p in enumerate(vocabulary.pieces)
    ]


def decoded(ids, writes: list[bytes]) -> str:
    """The text of a list of ids, without the blank that encoding puts first."""
    return b"".join([writes[i] for i in ids]).decode("utf-8", "replace").removeprefix(" ")


def parts(batches, column: int):
    """The batches in pieces of about `PART` bytes of text, at least a row each."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes) // PART
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(part)]))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if b > a:
                yield batch.slice(a, b - a)


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", check: bool = False) -> DataFrame:
    """All columns but the text, with ids and, if asked for, whether they decode to the text."""
    rest = [c for c in docs.columns if c not in (text, "ids", "round_trip")]
    fields = [docs.schema[c] for c in rest] + [T.StructField("ids", T.ArrayType(T.IntegerType()))]
    fields += [T.StructField("round_trip", T.BooleanType())] if check else []

    def batches(found):
        writes = surfaces(vocabulary)
        for batch in parts(found, len(rest)):
            texts = batch.column(len(rest)).to_pylist()
            ids = encoded(texts, vocabulary)
            arrays = [batch.column(i) for i in range(len(rest))] + [pa.array(ids, pa.list_(pa.int32()))]
            if check:
                same = [
                    None if x is None else decoded(i.tolist(), writes) == x.replace(SPACE, " ")
                    for x, i in zip(texts, ids)
                ]
                arrays.append(pa.array(same, pa.bool_()))
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in fields])

    return docs.select(*[F.col(f"`{c}`") for c in rest], F.col(text).cast("string")).mapInArrow(
        batches, T.StructType(fields)
    )


def decode(rows: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """All columns but the ids, with their text."""
    rest = [c for c in rows.columns if c not in (ids, "text")]
    schema = T.StructType([rows.schema[c] for c in rest] + [T.StructField("text", T.StringType())])

    def batches(found):
        writes = surfaces(vocabulary)
        for batch in found:
            texts = [None if x is None else decoded(x, writes) for x in batch.column(len(rest)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(rest))], pa.array(texts, pa.string())],
                names=[*rest, "text"],
            )

    return rows.select(*[F.col(f"`{c}`") for c in rest], F.col(ids)).mapInArrow(batches, schema)


def query(docs: DataFrame, path: str = MODEL) -> DataFrame:
    found = encode(docs.select(F.col("doc_id").cast("long"), "text"), load(path), check=True)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")
