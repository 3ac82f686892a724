"""From raw documents to token ids, each stage on what the one before has kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemart.llm import decontaminate, pieces, quality, simhash, toxicity
from quotemart.llm.common import fold, given, staged

# A stage can't be stated in SQL: the scores are learnt, and the pieces depend on a model file.
ORACLE_SQL: str | None = None
SEED, DROPOUT = 20, 0.1


def _learnable() -> Column:
    """Labels of one fold are left for measuring."""
    return fold(F.col("doc_id"), 3) != 1


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold once disguised words are restored."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, given(spark, sf_dir, "labels"), _learnable()))


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine finds good."""
    return quality.keep_good(docs, quality.train(docs, given(spark, sf_dir, "labels"), _learnable()))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints at most three bits apart connect, that with the smallest id."""
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten consecutive words of a benchmark item, nor a shorter item."""
    return decontaminate.drop_contaminated(docs, given(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document under merge-dropout, and whether they decode to its text."""
    return pieces.encoded(docs, dropout=DROPOUT, seed=SEED)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("quality", good),
    ("near_copies", without_near_copies),
    ("decontamination", without_benchmark),
    ("encoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what earlier stages keep is written to the shared folder and read again."""
    docs = given(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
