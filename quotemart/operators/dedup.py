"""One survivor per key, and the first rows of each group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Spark limits groups in the map tasks up to this many rows; the session may say otherwise.
LIMIT_SETTING, LIMIT_DEFAULT = "spark.sql.optimizer.windowGroupLimitThreshold", "1000"
SLICES = 64


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], rows: int) -> DataFrame:
    """The first ``rows`` rows of every key group; NULL keys form one group.

    Written as ``row_number() <= n`` because Spark then keeps at most ``n`` rows per key in every
    map task before the shuffle, so a hot key reaches its reducer already cut down. Where ``n`` is
    too large for that, every group is first cut in slices. A hash of the key leads the sort, so
    most comparisons end at one number.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*keys))
    if rows > int(df.sparkSession.conf.get(LIMIT_SETTING, LIMIT_DEFAULT)):
        sliced = hashed.withColumn("_slice", F.pmod(F.xxhash64(*df.columns), F.lit(SLICES)))
        hashed = _ranked(sliced, ["_slice", *keys], order, rows).drop("_slice")
    return _ranked(hashed, keys, order, rows).drop("_hash")


def _ranked(hashed: DataFrame, keys: Sequence[str], order: Sequence[Column], rows: int) -> DataFrame:
    window = Window.partitionBy("_hash", *keys).orderBy(*order)
    ranked = hashed.withColumn("_rank", F.row_number().over(window))
    return ranked.where(F.col("_rank") <= rows).drop("_rank")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key group. ``order`` must be total for a repeatable result."""
    return first_rows(df, keys, order, 1)


def first_positions(df: DataFrame, keys: Sequence[str], pos: str) -> DataFrame:
    """Positions of the first row of every key group, from a map-side combined ``min``."""
    return df.groupBy(*keys).agg(F.min(pos).alias(pos)).select(pos)


def mark_first(df: DataFrame, keys: Sequence[str], pos: str, mark: str, among: Column) -> DataFrame:
    """Flag the first row of every key group among the rows where ``among`` holds.

    Only positions are joined back; they are unique, so a hot key cannot overload a task.
    """
    firsts = first_positions(df.where(among), keys, pos).withColumn(mark, F.lit(True))
    return df.join(firsts, pos, "left").withColumn(mark, F.coalesce(F.col(mark), F.lit(False)))
