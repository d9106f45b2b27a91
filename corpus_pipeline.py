"""The corpus pipeline: documents through five stages, each on all that its predecessor kept.

1. `quality_rules`: documents that the base rules or a risk-controlled cutoff reject go.
2. `simhash_near_dedup`: one document of each group of near-duplicates stays (shingles of five words).
3. `secret_scan`: secrets are replaced by their kind.
4. `temperature_mixing`: sources appear as often as their weight asks for, every document at least once and none
   more than twice.
5. `sentence_pieces`: texts become piece ids.

The first four return the columns of documents. Null texts and blank texts fail the quality rules; tables
without labels leave the base rules; empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import (
    quality_rules,
    secret_grammars,
    sentence_pieces,
    simhash_variants,
    temperature_mixing,
)
from ledgerloom.llm.common import stored


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_variants.keep_first(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_grammars.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return temperature_mixing.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentence_pieces.encode(docs, sentence_pieces.load())


STAGES = [
    ("quality_rules", keep_quality),
    ("simhash_near_dedup", keep_one_of_each_group),
    ("secret_scan", redact_secrets),
    ("temperature_mixing", mix_sources),
    ("sentence_pieces", encode_pieces),
]

#: Fingerprints, automata and piece merging have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *first, (_, last) = STAGES
    for _, stage in first:
        docs = stored(stage(spark, docs, sf_dir))
    return last(spark, docs, sf_dir)
