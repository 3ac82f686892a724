"""A shuffled join in which no key outweighs a task, without help from adaptive execution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Pieces of heavy keys for each task: the more, the more evenly they spread.
PIECES = 4
PARTITIONS, DEFAULT_PARTITIONS = "spark.sql.shuffle.partitions", "200"


def heavy_keys(big: DataFrame, key: str, most: int) -> DataFrame:
    """(key, pieces) of the keys with more than ``most`` rows, counted in the map tasks."""
    counted = big.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most)
    return counted.select(key, F.ceil(F.col("_n") / most).alias("_pieces"))


def spread_join(big: DataFrame, small: DataFrame, key: str, total: int) -> DataFrame:
    """Inner join of ``big``, of about ``total`` rows, with ``small`` on one column.

    A key with more than its share of a task's rows is cut into pieces by a hash of the whole row,
    and its rows of ``small`` are repeated for each piece; all other keys are joined as they are.
    At most ``PIECES`` times the shuffle partitions many keys can be so heavy, which bounds the
    broadcast. Equal rows of ``big`` stay in one piece.
    """
    partitions = int(big.sparkSession.conf.get(PARTITIONS, DEFAULT_PARTITIONS))
    heavy = F.broadcast(heavy_keys(big, key, max(1, total // (PIECES * partitions))))
    piece = F.when(F.col("_pieces").isNull(), 0).otherwise(F.pmod(F.xxhash64(*big.columns), F.col("_pieces")))
    cut = big.join(heavy, key, "left").withColumn("_piece", piece).drop("_pieces")
    pieces = F.sequence(F.lit(0).cast("long"), F.coalesce("_pieces", F.lit(1)) - 1)
    repeated = small.join(heavy, key, "left").withColumn("_piece", F.explode(pieces)).drop("_pieces")
    return cut.join(repeated, [key, "_piece"]).drop("_piece")
