"""One query per operator over its whole table, as the result contracts ask."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from admitflow.llm import (
    fingerprints,
    infill,
    language,
    licenses,
    mixing,
    neardup,
    neighbours,
    packing,
    passages,
    pieces,
    secrets,
    toxicity,
    turns,
)
from admitflow.llm.common import table
from admitflow.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", "neighbours")


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(spark, table(spark, sf_dir, "documents"))


@query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("at")


@query
def op2_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.scan(spark, table(spark, sf_dir, "documents"))


@query
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.group(spark, table(spark, sf_dir, "documents"))


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.remove_repeats(spark, table(spark, sf_dir, "documents")).drop("kept_text")


@query
def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(spark, table(spark, sf_dir, "embeddings"))


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.audit(table(spark, sf_dir, "conversations"))


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.report(table(spark, sf_dir, "documents"))


@query
def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.report(table(spark, sf_dir, "documents"))
