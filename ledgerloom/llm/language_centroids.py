"""Language identification by nearest centroid.

A text becomes a vector of hashed character 1- to 3-grams (letters only, lower case, any other run as
one blank), weighted by log term count times inverse document frequency and scaled to length one. Each
language has several centroids from spherical k-means. The centroid with the largest cosine gives the
language; if that cosine is below nearly all of the language's own training texts, `rejected` is set.

The classifier is fitted on at most about `SAMPLE` texts per language, picked by a hash of the id, so the
driver sees a bounded table of vectors. Prediction is one pass over the whole texts, without a shuffle.

Defined cases: null text and text without a letter give `und` and score 0; with nothing to learn from,
every text gives `und`; rows with a null id have remainder null and take part in prediction only; ties go
to the language that sorts first. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMS = 4096
SAMPLE = 400
CENTROIDS = 4
FOLDS = 5
#: Share of a language's own training texts that the rejection limit lets fall below it.
REJECTED = 0.005
UNKNOWN = "und"


class Grams:
    """Counts hashed character grams; holds the table of letters."""

    def __init__(self, dims: int = DIMS):
        self.dims = dims
        self.letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)

    def counts(self, text: str | None) -> np.ndarray | None:
        """Gram counts of the whole text; None without a letter."""
        raw = (text or "").lower().encode("utf-32-le", "surrogatepass")
        code = np.frombuffer(raw, np.uint32)
        code = np.where(self.letter[code], code, np.uint32(32))
        if not len(code) or not (code != 32).any():
            return None
        blank = code == 32
        code = code[np.concatenate(([True], ~(blank[1:] & blank[:-1])))]
        code = np.concatenate(([32], code, [32])).astype(np.uint32)
        one = code * np.uint32(0x9E3779B1)
        two = (one[:-1] ^ np.uint32(0x5BD1E995)) * np.uint32(31) + one[1:]
        three = (two[:-1] ^ np.uint32(0x27D4EB2F)) * np.uint32(31) + one[2:]
        out = np.zeros(self.dims, np.float32)
        for grams in (one, two, three):
            mixed = (grams ^ (grams >> np.uint32(15))) * np.uint32(0x85EBCA77)
            out += np.bincount(mixed >> np.uint32(20), minlength=4096)[: self.dims]
        return out


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = np.log1p(counts) * idf
    return out / np.maximum(np.linalg.norm(out, axis=-1, keepdims=True), 1e-12)


def fold(column: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(FOLDS))


def training_vectors(docs: DataFrame, sample: int) -> list[tuple[str, np.ndarray]]:
    """(language, gram counts) of about `sample` texts of each language, alike in every run."""
    known = docs.where((fold() != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("id"), F.col("lang").cast("string").alias("lang"), "text"
    )
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    slots = 2**30
    limit = F.lit(0)
    for lang, n in sorted(sizes.items()):
        part = slots if n <= sample else slots * sample // n
        limit = F.when(F.col("lang") == lang, F.lit(part)).otherwise(limit)
    picked = known.where(F.pmod(F.xxhash64("id"), F.lit(slots)) < limit)

    def batches(found):
        grams = Grams()
        for batch in found:
            rows = [grams.counts(x) for x in batch.column(2).to_pylist()]
            keep = [i for i, x in enumerate(rows) if x is not None]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(keep, pa.int64())),
                    batch.column(1).take(pa.array(keep, pa.int64())),
                    pa.array([rows[i].astype("<f4").tobytes() for i in keep], pa.binary()),
                ],
                names=["id", "lang", "counts"],
            )

    rows = picked.mapInArrow(batches, "id long, lang string, counts binary").collect()
    rows.sort(key=lambda r: (r["lang"], r["id"], r["counts"]))
    return [(r["lang"], np.frombuffer(r["counts"], "<f4")) for r in rows]


def spherical_kmeans(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Up to k centroids of length one; starts from rows far from each other."""
    chosen = [int(np.argmax(rows @ rows.sum(0)))]
    near = rows @ rows[chosen[0]]
    while len(chosen) < min(k, len(rows)):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, rows @ rows[chosen[-1]])
    centres = rows[chosen]
    for _ in range(rounds):
        nearest = np.argmax(rows @ centres.T, axis=1)
        sums = np.stack([rows[nearest == i].sum(0) for i in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres[np.linalg.norm(centres, axis=1) > 0.5]


def fit(vectors: list[tuple[str, np.ndarray]], k: int = CENTROIDS) -> dict | None:
    """idf, centroids, the language of each centroid and each language's rejection limit."""
    if not vectors:
        return None
    counts = np.stack([v for _, v in vectors])
    langs = np.array([x for x, _ in vectors])
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(0))).astype(np.float32) + 1
    rows = weighted(counts, idf)
    names, centres, limits = [], [], {}
    for lang in sorted(set(langs.tolist())):
        own = rows[langs == lang]
        found = spherical_kmeans(own, k)
        names += [lang] * len(found)
        centres.append(found)
        limits[lang] = float(np.quantile((own @ found.T).max(1), REJECTED))
    return {"idf": idf, "names": names, "centres": np.concatenate(centres), "limits": limits}


def identify(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, lang_pred, score and rejected of every row."""

    def batches(found):
        grams = Grams()
        for batch in found:
            lang, score, rejected = [], [], []
            for text in batch.column(1).to_pylist():
                counts = grams.counts(text) if model else None
                if counts is None:
                    lang.append(UNKNOWN), score.append(0.0), rejected.append(True)
                    continue
                near = model["centres"] @ weighted(counts, model["idf"])
                best = int(np.argmax(near))
                name = model["names"][best]
                lang.append(name)
                score.append(float(np.clip(near[best], 0, 1)))
                rejected.append(bool(near[best] < model["limits"][name]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(lang, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(rejected, pa.bool_()),
                ],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(batches, "doc_id long, lang_pred string, score double, rejected boolean")


def query(docs: DataFrame) -> DataFrame:
    found = identify(docs, fit(training_vectors(docs, SAMPLE)))
    return found.select(
        "doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected"
    )
