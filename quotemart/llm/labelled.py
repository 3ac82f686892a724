"""The bounded sample of labelled documents that the classifiers are fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, allowed: Column, inputs: list[str], doc_id: str = "doc_id"
) -> DataFrame:
    """(*inputs, label) of at most ``rows`` labelled documents, those with the smallest hashes of their ids.

    ``allowed`` tells by the labels' own id whether a label may be learnt from. Labels other than 0
    and 1, and without an id, are passed over; of labels or documents with equal ids one is taken.
    """
    chosen = (
        labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & allowed)
        .groupBy(F.col(doc_id).alias("_id"))
        .agg(F.max(label).cast("int").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(rows)
    )
    # Bounded by ``rows``: small enough for every executor.
    found = docs.select(F.col(doc_id).alias("_id"), *inputs).join(F.broadcast(chosen), "_id")
    return found.groupBy("_id").agg(F.min(F.struct(*inputs, "_label")).alias("one")).select("one.*").withColumnRenamed("_label", "label")
