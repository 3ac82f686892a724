"""Connected components of a table of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemart.llm.common import staged


def _canonical(pairs: DataFrame) -> DataFrame:
    """Each link once, from its larger node to its smaller one."""
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of a node are hung on the smallest node next to it."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _canonical(both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, are hung on the smallest of them."""
    low = links.groupBy("a").agg(F.min("b").alias("m"))
    hung = links.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _canonical(hung.union(low.select("a", F.col("m").alias("b"))))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)`` but the roots themselves; a root is its component's smallest node.

    The driver sees one row a round. A node with many neighbours is reduced in the map tasks, and
    adaptive execution splits its rows in the join. An empty table of links gives no rows.
    """
    now = staged(_canonical(links), "links")
    state = _state(now)
    while state[0]:
        now = staged(_small_star(_large_star(now)), "links")
        last, state = state, _state(now)
        if state == last:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
