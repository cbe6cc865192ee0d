"""One query for each operator, over whole tables, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from folioflow.llm import (
    chat, exact_search, line_quality, mixing, nearest, neighbours, packing, pii, repetition, secrets, simhash, toxicity, vector_codes,
)
from folioflow.llm.common import table
from folioflow.llm.sql import ORACLE


def op1_multiprobe_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.neighbours(table(spark, sf_dir, "embeddings"))


def op2_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_quality.verdicts(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed"
    )


def op3_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_pareto_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op5_bootstrapped_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.found(table(spark, sf_dir, "documents")))


def op6_neighbour_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_randomness_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.found(table(spark, sf_dir, "documents")))


def op8_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(table(spark, sf_dir, "conversations"))


def op10_residual_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op11_kd_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_search.top(table(spark, sf_dir, "embeddings"))


def op12_integer_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.digest(table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.digest(repetition.found(repetition.planted(table(spark, sf_dir, "documents"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_multiprobe_hashing": op1_multiprobe_hashing,
    "op2_line_frequency": op2_line_frequency,
    "op3_covering_simhash": op3_covering_simhash,
    "op4_pareto_mixture": op4_pareto_mixture,
    "op5_bootstrapped_contexts": op5_bootstrapped_contexts,
    "op6_neighbour_vote": op6_neighbour_vote,
    "op7_randomness_battery": op7_randomness_battery,
    "op8_kneser_ney": op8_kneser_ney,
    "op9_perspective_rotation": op9_perspective_rotation,
    "op10_residual_packing": op10_residual_packing,
    "op11_kd_trees": op11_kd_trees,
    "op12_integer_codes": op12_integer_codes,
    "op13_periodic_runs": op13_periodic_runs,
}

__all__ = ["ORACLE", "QUERIES"]
