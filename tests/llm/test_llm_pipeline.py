"""The pipeline against the stages' own operators, and its behaviour on odd input."""

from __future__ import annotations

import corpus_pipeline
import __spark_entry__ as entry_points

from ledgerloom.llm import quality_rules, secret_grammars, sentence_pieces, simhash_variants, temperature_mixing

FOLDER = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "simhash_near_dedup", "secret_scan", "temperature_mixing", "sentence_pieces"]
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], FOLDER))
    assert all(df.columns == columns for df in out[1:-1])
    ids = [sorted(r["doc_id"] for r in df.collect()) for df in out]
    kept = {r["doc_id"] for r in quality_rules.query(docs, labels).collect() if r["kept"]}
    assert set(ids[1]) == kept
    groups = simhash_variants.near_copies(out[1]).collect()
    assert ids[2] == sorted({r["component"] for r in groups})
    assert ids[3] == ids[2] and secret_grammars.query(out[3]).where("n_assign + n_access + n_hex > 0").count() == 0
    assert set(ids[4]) == set(ids[3]) and len(ids[4]) > len(ids[3])
    assert ids[4] == sorted(r["doc_id"] for r in temperature_mixing.mix(out[3]).collect())
    texts = {r["doc_id"]: r["text"] for r in out[3].collect()}
    back = sentence_pieces.decode(out[5], sentence_pieces.load()).collect()
    assert all(r["text"] == texts[r["doc_id"]] for r in back) and len(back) == len(ids[4])
    run = corpus_pipeline.run(spark, FOLDER)
    assert sorted(r["doc_id"] for r in run.collect()) == ids[4]


def test_odd_documents(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "x " * 300_000, "en", None, 1), (1, "x " * 300_000, "en", None, 1)]
    good = " ".join(f"word{i}" for i in range(80))
    rows += [(2, good, None, "a", 5), (2, good, None, "a", 5), (3, good, None, "b", 5), (None, good + " end", "en", "b", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.limit(0)):
        out = table
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, out, FOLDER)
        ids = sorted({r["doc_id"] for r in out.collect()}, key=repr)
        # of the texts with enough different words, documents 2 and 3 and the one without an id are alike
        assert ids == ([2] if table is docs else [])


def test_no_row_is_lost_by_its_id(spark):
    """Rows of one id, or without one, go only if a similar text stays."""
    a, b, c = (" ".join(f"{name}{i}" for i in range(60)) for name in "abc")
    d, e = (" ".join(f"{name}{i}" for i in range(60)) for name in "de")
    near = c.replace("c30", "new")
    rows = [(1, a), (2, a), (2, b), (None, c), (None, c), (5, near), (None, d), (None, e), (7, b), (8, d), (8, d), (9, None), (9, None), (10, "")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, h int")
    out = simhash_variants.keep_first(df)
    assert out.columns == ["doc_id", "text", "h"]
    kept = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)
    assert kept == sorted([(1, a), (2, b), (5, near), (8, d), (None, e), (9, None)], key=repr)
    alone = spark.createDataFrame([(None, c), (None, c), (None, a)], "doc_id long, text string")
    assert sorted(r["text"] for r in simhash_variants.keep_first(alone).collect()) == sorted([a, c])
    assert simhash_variants.keep_first(df.limit(0)).collect() == []


def test_registered():
    queries = entry_points.queries()
    numbers = sorted(int(k[2:].split("_")[0]) for k in queries if k.startswith("op") and k[2:3].isdigit())
    assert numbers == list(range(1, 14)) and "pipeline" in queries
