"""The registered queries of this package and their check SQL."""

from __future__ import annotations

from ledgerloom.llm import (
    checks,
    language_centroids,
    letter_trees,
    line_blocks,
    projection_forest,
    quality_rules,
    secret_grammars,
    sentence_pieces,
    simhash_variants,
    suffix_levels,
    suffix_states,
    temperature_mixing,
    truncation_peeling,
    url_cascade,
)


def _table(spark, folder: str, name: str):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_suffix_levels(spark, folder):
    return suffix_levels.query(_table(spark, folder, "documents"))


def op2_url_cascade(spark, folder):
    return url_cascade.judge(_table(spark, folder, "pages"))


def op3_temperature_mixing(spark, folder):
    return temperature_mixing.query(_table(spark, folder, "documents"))


def op4_simhash_variants(spark, folder):
    return simhash_variants.query(_table(spark, folder, "documents"))


def op5_projection_forest(spark, folder):
    return projection_forest.near_duplicates(_table(spark, folder, "embeddings"))


def op6_line_blocks(spark, folder):
    return line_blocks.extract(_table(spark, folder, "pages"))


def op7_secret_grammars(spark, folder):
    return secret_grammars.query(_table(spark, folder, "documents"))


def op8_quality_rules(spark, folder):
    return quality_rules.query(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op9_language_centroids(spark, folder):
    return language_centroids.query(_table(spark, folder, "documents"))


def op10_sentence_pieces(spark, folder):
    return sentence_pieces.query(_table(spark, folder, "documents"))


def op11_letter_trees(spark, folder):
    return letter_trees.query(_table(spark, folder, "documents"))


def op12_suffix_states(spark, folder):
    return suffix_states.query(_table(spark, folder, "documents"))


def op13_truncation_peeling(spark, folder):
    return truncation_peeling.query(_table(spark, folder, "conversations"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_suffix_levels,
        op2_url_cascade,
        op3_temperature_mixing,
        op4_simhash_variants,
        op5_projection_forest,
        op6_line_blocks,
        op7_secret_grammars,
        op8_quality_rules,
        op9_language_centroids,
        op10_sentence_pieces,
        op11_letter_trees,
        op12_suffix_states,
        op13_truncation_peeling,
    )
}

SQL = checks.SQL
