"""Size-checked broadcast joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Lookup rows hold a key and a few names of at most 255 characters: some 50 MB at this bound.
BROADCAST_ROWS = 100_000


def has_at_most(df: DataFrame, rows: int) -> bool:
    """Whether a DataFrame has at most ``rows`` rows; counted in the tasks that read it."""
    return df.count() <= rows


def lookup_side(df: DataFrame, bound: DataFrame | None = None, rows: int = BROADCAST_ROWS, size: int | None = None) -> DataFrame:
    """Mark the small side of a join for broadcast if its size is proven small.

    ``size`` is a number of rows that ``df`` is known not to exceed, as its write has counted them;
    with it no job is started. Without it rows are counted: those of ``bound``, a cheaper DataFrame
    known to have no fewer, or of ``df``. Beyond the bound the join is left to a shuffle, whose hot
    partitions adaptive execution splits.
    """
    small = size <= rows if size is not None else has_at_most(df if bound is None else bound, rows)
    return F.broadcast(df) if small else df
