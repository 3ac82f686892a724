"""Shards by a hierarchical weighted hash tree.

Regions hold racks, racks hold shards, and every node has a weight. A key descends from the root:
among a node's children it draws a number for each, exponentially distributed with the child's weight
as its rate and fixed by key and child, and follows the smallest. A child is followed in proportion
to its weight, and a key's choice among children changes only to a child whose weight grew, or away
from one whose weight fell: what moves, moves within subtrees whose weights change.

A shard added later stands in a region of its own. No other weight changes, so that the rows it
takes go into it alone and all others stay.

Built with DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemart.llm.common import staged

SHARDS, PER_REGION, PER_RACK = 24, 12, 4
# Rows of a shard are numbered in so many parts, each in one task.
PARTS = 256
# Equal rows are numbered in pieces of at most so many, which lie in parts of their own.
PIECE = 100_000
# A draw uses so many hex digits of a hash.
DIGITS = 13


@dataclass(frozen=True)
class Node:
    """A region, rack or shard: its name and weight, and what it holds; a shard has a number."""

    name: str
    weight: float
    children: tuple[Node, ...] = ()
    shard: int | None = None


def branch(name: str, children: list[Node]) -> Node:
    """A node that weighs what its children weigh."""
    return Node(name, sum(c.weight for c in children), tuple(children))


def leaf(shard: int, weight: float = 1.0) -> Node:
    """A shard."""
    return Node(f"shard {shard}", weight, (), shard)


def tree(shards: int, base: int = SHARDS, per_region: int = PER_REGION, per_rack: int = PER_RACK) -> Node:
    """The tree of so many equal shards: the first ``base`` in full regions, each later one in a region of its own."""
    if shards < 1:
        raise ValueError("a tree has at least one shard")
    regions = []
    for r, start in enumerate(range(0, min(shards, base), per_region)):
        inside = range(start, min(start + per_region, shards, base))
        racks = [branch(f"rack {r}.{k}", [leaf(s) for s in inside[a : a + per_rack]]) for k, a in enumerate(range(0, len(inside), per_rack))]
        regions.append(branch(f"region {r}", racks))
    for s in range(base, shards):
        regions.append(branch(f"region of shard {s}", [branch(f"rack of shard {s}", [leaf(s)])]))
    return branch("root", regions)


def draw(key: Column, name: Column, weight: Column) -> Column:
    """A node's draw for a key: an exponential number with the node's weight as its rate."""
    hashed = F.substring(F.md5(F.concat_ws("|", key, name).cast("binary")), 1, DIGITS)
    return -F.log((F.conv(hashed, 16, 10).cast("double") + 0.5) / 16.0**DIGITS) / weight


def descend(rows: DataFrame, key: Column, root: Node, shard: str) -> DataFrame:
    """The rows with the shard that their key descends to, one level of the tree after the other.

    Nodes without weight get nothing; of equal draws the first child's counts.
    """
    nodes, depth, level = [root], 0, [root]
    while level := [c for n in level for c in n.children if c.weight > 0]:
        nodes += level
        depth += 1
    number = {id(n): k for k, n in enumerate(nodes)}
    if any(n.shard is None and not any(c.weight > 0 for c in n.children) for n in nodes):
        raise ValueError("every region and rack needs a shard with a weight")
    kind = "array<struct<name:string,weight:double,node:int>>"
    table = F.array(
        *(
            F.array(*(F.struct(F.lit(c.name), F.lit(float(c.weight)), F.lit(number[id(c)])) for c in n.children if c.weight > 0)).cast(kind)
            for n in nodes
        )
    )
    rows = rows.withColumn(shard, F.lit(0))
    for _ in range(depth):
        draws = F.transform(F.element_at(table, F.col(shard) + 1), lambda c: F.struct(draw(key, c["name"], c["weight"]).alias("draw"), c["node"].alias("node")))
        rows = rows.withColumn(shard, F.coalesce(F.array_min(draws)["node"], F.col(shard)))
    return rows.withColumn(shard, F.element_at(F.array(*(F.lit(n.shard).cast("int") for n in nodes)), F.col(shard) + 1))


def placed(
    docs: DataFrame, before: Node, after: Node | None = None, text: str = "text", doc_id: str = "doc_id", piece: int = PIECE
) -> DataFrame:
    """(doc_id, size, text_crc32, shard, grown_shard, slot) for every document row.

    The id alone decides the shard; a null id counts as the empty key. A null text has no bytes: the
    crc32 of nothing is 0 and the size 8. Slots count the rows of a shard from 0, without gaps, in
    the order of hash part, id, crc32 and size; rows equal in all of these are alike, so that any of
    them may have any of their slots. They are counted before they are numbered, and numbered in
    pieces of at most ``piece``, so no key or text, however common, is gathered in one task. An empty table gives no rows; other columns play no part.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(raw) + 8).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    found = descend(rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("all")), key, before, "shard")
    found = descend(found, key, after, "grown_shard") if after else found.withColumn("grown_shard", F.lit(None).cast("int"))
    cut = found.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(all - 1) div {piece}"))))
    cut = cut.withColumn("n", F.least(F.lit(piece).cast("long"), F.col("all") - F.col("piece") * piece)).drop("all")
    part = F.pmod(F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(PARTS)) + F.col("piece"), F.lit(PARTS)).cast("int")
    alike = staged(cut.withColumn("part", part), "placed")
    # At most one row for each shard and part.
    sums = alike.groupBy("shard", "part").agg(F.sum("n").alias("n"))
    ahead = sums.alias("a").join(F.broadcast(sums.alias("b")), (F.col("a.shard") == F.col("b.shard")) & (F.col("b.part") < F.col("a.part")), "left")
    offsets = ahead.groupBy(F.col("a.shard").alias("shard"), F.col("a.part").alias("part")).agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size", "piece").rowsBetween(Window.unboundedPreceding, -1)
    numbered = alike.withColumn("ahead", F.coalesce(F.sum("n").over(within), F.lit(0))).join(F.broadcast(offsets), ["shard", "part"])
    first = F.col("offset") + F.col("ahead")
    return numbered.withColumn("slot", F.explode(F.sequence(first, first + F.col("n") - 1))).select(
        "doc_id", "size", "text_crc32", "shard", "grown_shard", F.col("slot").cast("long").alias("slot")
    )
