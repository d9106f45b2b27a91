"""Secret scan by grammar inference.

Credentials that the three base patterns find serve as labelled examples. Their character classes feed a
prefix tree per kind; states whose end and next-class frequencies agree within the Hoeffding bound are
merged, which gives a probabilistic automaton of the kind's format. Every other token of at least the shortest
labelled length is scored by its mean log likelihood per character under the automata; tokens at least as
likely as nearly all labelled examples become spans of kind `format`.

One pass over the whole texts finds base spans and candidates; what it stores of a candidate is its span and its
classes, not its characters. Automata are fitted on the driver from at most `SAMPLE` examples per
kind, picked by hash.

Defined cases: null text is empty; without labelled examples there are no automata and only base spans;
overlapping base spans of different kinds all stay; a candidate that lies in one is not scored, one that holds or
partly overlaps one is. Offsets are code points. Repeated rows each give a row. Other columns pass through `redact` unchanged.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored

#: The base patterns and their least lengths, in the order of their kinds.
KEYS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex")
LEAST_ASSIGN = 12

CANDIDATE = re.compile(rf"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{{{LEAST_ASSIGN},}}")
CLASSES = str.maketrans(
    {
        **{chr(c): "d" for c in range(48, 58)},
        **{chr(c): "h" for c in range(97, 103)},
        **{chr(c): "l" for c in range(103, 123)},
        **{chr(c): "U" for c in range(65, 91)},
    }
)
SAMPLE = 200
#: Confidence of the Hoeffding test that keeps two states apart.
ALPHA = 0.05
#: Share of the labelled examples that the likelihood limit lets fall below it.
MISSED = 0.02
UNSEEN = 1e-4


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by start, then kind as listed."""
    found = []
    lower = text.lower()
    if any(key in lower for key in KEYS):
        found += [
            ("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN
        ]
    found += [("access", *m.span()) for m in ACCESS.finditer(text)] if "AKIA" in text else []
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Tokens of the shortest labelled length or more that do not lie in a base span."""
    out, at, reach = [], 0, 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while at < len(base) and base[at][1] <= start:
            reach = max(reach, base[at][2])
            at += 1
        if end > reach:
            out.append((start, end))
    return out


def value(text: str, kind: str, start: int, end: int) -> str:
    """The credential of a base span without the name before it."""
    return ASSIGN.match(text, start)[2] if kind == "assign" else text[start:end]


SPAN = "struct<kind: string, start: long, end: long, classes: string>"


def scan(docs: DataFrame) -> DataFrame:
    """(id, spans): base spans and unscored candidates (kind null) with their character classes."""
    kind = pa.list_(
        pa.struct(
            [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("classes", pa.string())]
        )
    )

    def one(text):
        text = text or ""
        base = base_spans(text)
        out = [
            {"kind": k, "start": s, "end": e, "classes": value(text, k, s, e).translate(CLASSES)}
            for k, s, e in base
        ]
        return out + [
            {"kind": None, "start": s, "end": e, "classes": text[s:e].translate(CLASSES)}
            for s, e in candidates(text, base)
        ]

    def batches(found):
        for batch in found:
            spans = pa.array([one(x) for x in batch.column(1).to_pylist()], kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), spans], names=["doc_id", "spans"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(batches, f"doc_id long, spans array<{SPAN}>")


class Automaton:
    """Frequencies of one kind's format: states[i] = {class: (next state, count)}, ends[i], seen[i]."""

    def __init__(self, examples: list[str], alpha: float = ALPHA):
        self.states, self.ends, self.seen = [{}], [0], [0]
        for text in examples:
            self._add(text)
        self._merge(alpha)
        scores = sorted(self.score(x) for x in examples)
        self.limit = scores[int(MISSED * len(scores))] if scores else math.inf

    def _add(self, text: str) -> None:
        at = 0
        for c in text:
            self.seen[at] += 1
            if c not in self.states[at]:
                self.states[at][c] = [len(self.states), 0]
                self.states.append({})
                self.ends.append(0)
                self.seen.append(0)
            edge = self.states[at][c]
            edge[1] += 1
            at = edge[0]
        self.seen[at] += 1
        self.ends[at] += 1

    def _alike(self, a: int, b: int, alpha: float) -> bool:
        """Whether both states and all states below them agree within the bound."""
        width = math.sqrt(0.5 * math.log(2 / alpha))
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.seen[a], self.seen[b]
            if not n or not m:
                continue
            bound = width * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            own, other = self.states[a], self.states[b]
            pairs = [(self.ends[a], self.ends[b])]
            pairs += [(own.get(c, (0, 0))[1], other.get(c, (0, 0))[1]) for c in {*own, *other}]
            if any(abs(x / n - y / m) > bound for x, y in pairs):
                return False
            todo += [(own[c][0], other[c][0]) for c in own if c in other and own[c][0] != other[c][0]]
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below b to the state a."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.seen[a] += self.seen[b]
            self.ends[a] += self.ends[b]
            for c, (to, count) in self.states[b].items():
                if c in self.states[a]:
                    self.states[a][c][1] += count
                    todo.append((self.states[a][c][0], to))
                else:
                    self.states[a][c] = [to, count]

    def _merge(self, alpha: float) -> None:
        """Take the tree's states breadth first; each joins the first settled state it agrees with."""
        settled = [0]
        while True:
            blue = next(
                ((a, c) for a in settled for c, (b, _) in sorted(self.states[a].items()) if b not in settled),
                None,
            )
            if blue is None:
                return
            a, c = blue
            b = self.states[a][c][0]
            for red in settled:
                if self._alike(red, b, alpha):
                    self.states[a][c][0] = red
                    self._fold(red, b)
                    break
            else:
                settled.append(b)

    def score(self, text: str) -> float:
        """Mean log likelihood per class, the end counted as one."""
        at, total = 0, 0.0
        for c in text:
            to, count = self.states[at].get(c, (None, 0))
            if to is None:
                return -math.inf
            total += math.log(max(count / self.seen[at], UNSEEN))
            at = to
        total += math.log(max(self.ends[at] / self.seen[at], UNSEEN))
        return total / (len(text) + 1)


def fit(found: DataFrame, sample: int = SAMPLE) -> list[Automaton]:
    """An automaton for each kind with examples."""
    spans = found.select(F.explode("spans").alias("s")).select("s.kind", "s.classes").where("kind IS NOT NULL")
    out = []
    for kind in KINDS:
        own = spans.where(F.col("kind") == kind).select("classes").distinct()
        rows = own.orderBy(F.xxhash64("classes"), "classes").limit(sample).collect()
        if rows:
            out.append(Automaton([r["classes"] for r in rows]))
    return out


def judged(found: DataFrame, automata: list[Automaton]) -> DataFrame:
    """(doc_id, spans): base spans, and candidates that an automaton accepts as kind `format`."""

    def batches(batches_):
        for batch in batches_:
            rows = []
            for spans in batch.column(1).to_pylist():
                own = []
                for s in spans or []:
                    if s["kind"] is None:
                        if not any(a.score(s["classes"]) >= a.limit for a in automata):
                            continue
                        s["kind"] = "format"
                    own.append({k: s[k] for k in ("kind", "start", "end")})
                rows.append(own)
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=["doc_id", "spans"])

    return found.mapInArrow(
        batches, "doc_id long, spans array<struct<kind: string, start: long, end: long>>"
    )


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of every row: all secrets found."""
    found = stored(scan(docs))
    return judged(found, fit(found))


def query(docs: DataFrame) -> DataFrame:
    order = F.create_map(*[x for i, k in enumerate((*KINDS, "format")) for x in (F.lit(k), F.lit(i))])
    keyed = F.transform(
        "spans", lambda s: F.struct(s["start"], order[s["kind"]], s["kind"], s["end"])
    )
    text = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    found = find(docs).select("doc_id", F.sort_array(keyed).alias("spans"))
    base = F.filter("spans", lambda s: s["kind"] != "format")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(text(base), 256).alias("base_sha256"),
        text("spans").alias("spans"),
        count("format").alias("n_format"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """The rows with each secret replaced by its kind in brackets; n_chars follows the text."""
    found = stored(scan(docs))
    automata = fit(found)
    at, columns = docs.columns.index("text"), docs.columns
    length = columns.index("n_chars") if "n_chars" in columns else None

    def clean(text):
        if not text:
            return text
        base = base_spans(text)
        own = base + [
            ("format", s, e)
            for s, e in candidates(text, base)
            if any(a.score(text[s:e].translate(CLASSES)) >= a.limit for a in automata)
        ]
        out, end = [], 0
        for kind, s, e in sorted(own, key=lambda x: (x[1], -x[2])):
            if s >= end:
                out += [text[end:s], f"[{kind}]"]
            end = max(end, e)
        return "".join([*out, text[end:]])

    def batches(batches_):
        for batch in batches_:
            arrays = batch.columns
            arrays[at] = pa.array([clean(x) for x in batch.column(at).to_pylist()], pa.string())
            if length is not None:
                kind = arrays[length].type
                arrays[length] = pc.utf8_length(arrays[at]).cast(kind)
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return docs.mapInArrow(batches, docs.schema)
