"""Build a training corpus from ``documents``: five stages, each written as Parquet and read by the next.

    quality rules -> SimHash near-dedup -> PII pseudonyms -> mix to target weights -> packing

Every stage but the last returns the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.llm import mixing, packing, pii, rules, simhash
from hitloom.llm.common import cut, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lie beyond a fence of their language and source go."""
    return rules.kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id."""
    return simhash.drop_near_duplicates(docs)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced; n_chars follows the new text."""
    done = pii.pseudonymise(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        done = done.withColumn("n_chars", F.when(F.col("n_pii") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return done.select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of power-of-two length, a row each."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules), ("near_dedup", near_dedup), ("pii", pseudonyms), ("mix", mix), ("pack", pack)]

# Tokens, word hashes and the cube method have no SQL form; see tests/llm/test_pipeline.py.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
