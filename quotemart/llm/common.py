"""What the training-data operators share: staged tables, fold numbers, the given tables."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemart.session import scratch_dir

# Python workers get texts in record batches; inside a batch they work on slices of about this many bytes.
SLICE_BYTES = 1 << 20


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write rows below the cluster's shared folder and return them as read back.

    What follows starts from the written rows: they are computed once, row numbers given before the
    write stay as they are, and a lost executor costs no more than a new read.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def given(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{folder}/{table}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """Fold of a document: crc32 of its id as text, modulo the folds; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """Mark a side of a join for broadcast if a count proves it has at most ``rows`` rows.

    Beyond that the join is left to a shuffle, whose hot partitions adaptive execution splits.
    """
    return F.broadcast(df) if df.count() <= rows else df


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the DataFrame doesn't have yet, by upper or lower case either."""
    taken = {c.lower() for c in df.columns}
    return next(n for n in (f"{name}{'_' * k}" for k in count(1)) if n.lower() not in taken)


def slices(sizes: list[int], most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Cut a batch into runs of texts of about ``most`` bytes; a longer text is a run of its own."""
    start = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)
