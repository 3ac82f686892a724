"""The training-data queries over the given tables, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemart.llm import (
    ann,
    decontaminate,
    divergence,
    htmltext,
    jaccard,
    language,
    merkle,
    pieces,
    quality,
    sharding,
    simhash,
    sql,
    toxicity,
    warc,
)
from quotemart.llm.common import fold, given


# Folds of the documents: that of this remainder is held out, labels and languages are learnt from the others.
LABEL_FOLDS, LABEL_HELD_OUT = 3, 1
LANG_FOLDS, LANG_HELD_OUT = 5, 0


def rated(scores: DataFrame, least: float) -> DataFrame:
    """Scores with the held-out fold and the decision."""
    return scores.select(
        "doc_id",
        (fold(F.col("doc_id"), LABEL_FOLDS) == LABEL_HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= least).cast("int").alias("predicted"),
    )


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document."""
    docs = given(spark, folder, "documents")
    allowed = fold(F.col("doc_id"), LABEL_FOLDS) != LABEL_HELD_OUT
    model = toxicity.train(docs, given(spark, folder, "labels"), allowed)
    return rated(toxicity.scored(docs, model), toxicity.TOXIC)


def op2_language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """Main language of every document."""
    docs = given(spark, folder, "documents")
    held_out = fold(F.col("doc_id"), LANG_FOLDS) == LANG_HELD_OUT
    found = language.predicted(docs, language.train(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "languages")


def op3_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document inside windows of benchmark items, and the items."""
    found = decontaminate.contamination(given(spark, folder, "documents"), given(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and class of near copies of every document."""
    return simhash.classes(given(spark, folder, "documents"))


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Shard of every document in a tree of 24 shards, and in that with one more."""
    found = sharding.placed(given(spark, folder, "documents"), sharding.tree(sharding.SHARDS), sharding.tree(sharding.SHARDS + 1))
    return found.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    return warc.archived(given(spark, folder, "pages")).drop("url")


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document."""
    docs = given(spark, folder, "documents")
    allowed = fold(F.col("doc_id"), LABEL_FOLDS) != LABEL_HELD_OUT
    machine = quality.train(docs, given(spark, folder, "labels"), allowed)
    return rated(quality.scored(docs, machine), quality.GOOD)


def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of every document under merge-dropout, and whether they decode to its text."""
    return pieces.encoded(given(spark, folder, "documents"), dropout=0.1, seed=20)


def op9_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return htmltext.extracted(given(spark, folder, "pages"))


def op10_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest vectors found for every vector whose id is divisible by 20."""
    return ann.search(given(spark, folder, "embeddings"))


def op11_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Set size and class of similar documents of every document."""
    return jaccard.classes(given(spark, folder, "documents"))


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Proof of every document, and whether a copy without some line feeds still proves."""
    even = fold(F.col("doc_id"), 2) == 0
    bare = F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.audited(given(spark, folder, "documents"), {"text": bare})


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """Divergence of every source from the others of its language, and the terms it overuses."""
    return divergence.audited(given(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_language_mixture": op2_language_mixture,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_simhash_dedup": op4_simhash_dedup,
    "op5_sharding": op5_sharding,
    "op6_warc": op6_warc,
    "op7_quality": op7_quality,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_html_extraction": op9_html_extraction,
    "op10_nearest_neighbours": op10_nearest_neighbours,
    "op11_ngram_jaccard_join": op11_ngram_jaccard_join,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_source_divergence": op13_source_divergence,
}

ORACLE: dict[str, str] = {
    "op3_benchmark_decontamination": sql.DECONTAMINATION,
    "op6_warc": sql.ARCHIVES,
    "op11_ngram_jaccard_join": sql.JACCARD,
    "op12_merkle_manifest": sql.MANIFEST,
    "op13_source_divergence": sql.DIVERGENCE,
}
