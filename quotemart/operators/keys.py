"""Dense surrogate keys without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_DIGITS = 3


def natural_text(columns: Sequence[Column]) -> Column:
    """Key text of a natural key: its parts joined by an underscore, NULL as an empty part."""
    return F.concat_ws("_", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def assign_keys(
    new: DataFrame,
    natural: Sequence[Column],
    key: str,
    existing: DataFrame | None = None,
    digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """Add ``key``: consecutive integers above the greatest key of ``existing``.

    Rows are ranked by the md5 of their natural key. Its first hex digits cut the ranking into
    ``16 ** digits`` even buckets; each bucket is numbered by its own task and shifted by the rows
    of the buckets before it. Bucket and rank follow from the row alone, so a re-run task gives the
    same keys and nothing has to be staged. Natural keys must be unique in ``new``.
    """
    tagged = new.withColumn("_hash", F.md5(natural_text(natural).cast("binary"))).withColumn(
        "_bucket", F.substring("_hash", 1, digits)
    )
    # At most 16 ** digits rows, plus one row holding the greatest key in use.
    sizes = tagged.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    if existing is not None:
        used = existing.agg(F.coalesce(F.max(key), F.lit(0)).cast("long").alias("_size"))
        sizes = sizes.unionByName(used.select(F.lit("").alias("_bucket"), "_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift")
    )
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash", *natural))
    return (
        tagged.withColumn("_place", rank)
        .join(F.broadcast(shifts), "_bucket")
        .withColumn(key, (F.col("_shift") + F.col("_place")).cast("int"))
        .drop("_bucket", "_hash", "_place", "_shift")
    )
