"""A corpus pipeline: language identification, near-duplicates, mixing of sources, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language, mixing, near_duplicates, packing
from tidemark.llm.tables import shielded
from tidemark.session import work_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose language stays open, go; the others keep their columns.
    The models learn from the rows at hand that carry a language."""
    columns = docs.columns
    docs, names_back = shielded(docs, ["lang_pred", "score"])
    judged = language.identify(docs)
    kept = judged.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= language.MIN_SCORE))
    return names_back(kept.select(docs.columns)).select(columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest doc_id."""
    return near_duplicates.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as drawn for its source, in a random order."""
    columns = docs.columns
    docs, names_back = shielded(docs, ["copy", "copies", "rate", "shuffle_key"])
    return names_back(mixing.mix_sources(docs).select(docs.columns)).select(columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in its sequence; a document drawn several times is packed as often."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("near_dedup", deduplicate),
    ("mix_sources", mix),
    ("pack", pack),
]

#: Language models and tokenizers have no SQL; the tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
