"""Manifest of a dataset as a content-addressed Merkle DAG, and proofs by descent.

Every row is a leaf. The leaves of a source, in the order of their ids, are joined in runs of
``fan`` to their parents, level by level, up to the source's root; the sources' roots, in the order
of their names, are joined alike to the root of the dataset. The store holds one record for each
digest, the digests of its children; equal subtrees share their records.

A leaf is proven by descending from the root: the base-``fan`` digits of its rank among the sources,
and then of its rank in the source, choose a child at every level, and the children not chosen are
collected as a path segment. The segments in reverse are the proof from the leaf up. Requests travel
together while their digits agree, so the upper levels have few rows and none is asked for by many.

Ranks come from a range partitioning: rows of a source before a part, and then within it, are
counted, so a source of any size is ranked by many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemart.llm.common import small_side, staged

FAN = 3
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
# Sources on a broadcast side: a name and two digests each.
SMALL = 100_000


@dataclass
class Tree:
    """Trees by name: ``levels[k]`` holds (tree, rank, n, digest, children) of the nodes k + 1 above the leaves.

    ``tops(tree, n, digest, height)`` holds each tree's root and how many levels lie below it.
    """

    levels: list[DataFrame]
    tops: DataFrame


@dataclass
class Manifest:
    """``leaves(doc_id, tree, row, leaf, other, n, rank)``, the trees of the sources, that above them, and the root.

    ``names(all, tree, digest, height, n, rank)`` holds the sources' roots in their order.
    """

    leaves: DataFrame
    sources: Tree
    above: Tree
    names: DataFrame
    root: str | None


def framed(value: Column) -> Column:
    """A field of a leaf: its length in UTF-8 bytes, a colon and its text; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest_of(*texts: Column) -> Column:
    """Lower-case hex SHA-256 of texts written one after the other."""
    return F.sha2(F.concat(*texts).cast("binary"), 256)


def ranked(rows: DataFrame, tree: str, order: list[str], name: str) -> DataFrame:
    """The rows with their ``rank`` from 0 within their tree and the tree's ``n`` rows.

    ``order`` should end in a column that tells all rows apart, so that equal rows may lie in several
    parts. ``rows`` should be a written table. Trees are told by a text that is not null.
    """
    parts = staged(rows.repartitionByRange(tree, *order).withColumn("part", F.spark_partition_id()), name)
    # At most one row for each part, and one more for each tree.
    counted = parts.groupBy(tree, "part").agg(F.count("*").alias("held"))
    before = Window.partitionBy(tree).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select(
        tree, "part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("ahead"), F.sum("held").over(Window.partitionBy(tree)).alias("n")
    )
    place = F.row_number().over(Window.partitionBy(tree, "part").orderBy(*order)) - 1
    return parts.withColumn("place", place).join(small_side(offsets, SMALL), [tree, "part"]).withColumn(
        "rank", F.col("ahead") + F.col("place")
    ).drop("part", "ahead", "place")


def grow(nodes: DataFrame, fan: int = FAN) -> Tree:
    """Trees over (tree, rank, n, digest), a written table; each level is written before the next."""
    most, height, levels = nodes.agg(F.max("n")).first()[0] or 0, 0, []
    tops = nodes.where("n = 1").select("tree", "digest", F.lit(0).alias("height"))
    while most > 1:
        height, most = height + 1, -(-most // fan)
        placed = nodes.where("n > 1").select(
            "tree",
            F.expr(f"rank div {fan}").alias("rank"),
            F.expr(f"(n + {fan - 1}) div {fan}").alias("n"),
            F.struct(F.expr(f"rank % {fan}").alias("digit"), "digest").alias("child"),
        )
        runs = placed.groupBy("tree", "rank", "n").agg(F.sort_array(F.collect_list("child"))["digest"].alias("children"))
        level = runs.withColumn("digest", digest_of(F.array_join("children", "")))
        nodes = staged(level, f"level-{height}")
        levels.append(nodes)
        tops = tops.union(nodes.where("n = 1").select("tree", "digest", F.lit(height)))
    return Tree(levels, tops)


def manifest(
    docs: DataFrame, fields: list[str] | None = None, doc_id: str = "doc_id", source: str = "source", copy: Mapping[str, Column] | None = None
) -> Manifest:
    """The manifest of a table; ``copy`` says which fields a copy to be audited holds in another form.

    Leaves of a source ascend by id, nulls first, equal ids by digest; sources ascend by name in
    bytes, the null one first. Whole texts count, however long. Repeated rows are leaves of their
    own; an empty table has no leaves and no root; columns besides ``fields`` play no part.
    """
    fields = fields or FIELDS
    # Names keep their order, and null comes before all.
    tree = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        tree.alias("tree"),
        digest_of(*(framed(F.col(f)) for f in fields)).alias("leaf"),
        digest_of(*(framed((copy or {}).get(f, F.col(f))) for f in fields)).alias("other"),
        F.monotonically_increasing_id().alias("row"),
    )
    leaves = staged(ranked(staged(rows, "leaves"), "tree", ["doc_id", "leaf", "row"], "ordered"), "ranked")
    sources = grow(leaves.select("tree", "rank", "n", F.col("leaf").alias("digest")))
    names = staged(sources.tops.select(F.lit("").alias("all"), "tree", "digest", "height"), "subroots")
    names = staged(ranked(names, "all", ["tree"], "subroots"), "names")
    above = grow(names.select(F.col("all").alias("tree"), "rank", "n", "digest"))
    top = above.tops.first()
    return Manifest(leaves, sources, above, names, top["digest"] if top else None)


def descend(starts: DataFrame, levels: list[DataFrame], wanted: DataFrame | None = None, fan: int = FAN) -> DataFrame:
    """Leaves below the start nodes: (tree, rank, digest, path), the path from the top down.

    ``starts(tree, digest, height, path)`` names nodes and the path so far; a path segment holds the
    digests beside the chosen child, ``before`` and ``after`` it. ``wanted(tree, rank)`` are the
    leaves asked for, by default all.
    """

    def asked(nodes: DataFrame, height: int) -> DataFrame:
        if wanted is None:
            return nodes
        prefix = F.expr(f"rank div {fan**height}").alias("rank")
        return nodes.join(wanted.select("tree", prefix).distinct(), ["tree", "rank"], "left_semi").select(*nodes.columns)

    def entering(height: int) -> DataFrame:
        return starts.where(F.col("height") == height).select("tree", F.lit(0).cast("long").alias("rank"), "digest", "path")

    at = None
    for height in range(len(levels), 0, -1):
        here = asked(entering(height) if at is None else at.unionByName(entering(height)), height)
        store = levels[height - 1].select("digest", "children").dropDuplicates(["digest"])
        chosen = here.join(store, "digest").select("tree", "rank", "path", "children", F.posexplode("children").alias("digit", "child"))
        segment = F.struct(
            F.array_join(F.slice("children", F.lit(1), F.col("digit")), "").alias("before"),
            F.array_join(F.slice("children", F.col("digit") + 2, F.lit(fan)), "").alias("after"),
        )
        at = chosen.select(
            "tree",
            (F.col("rank") * fan + F.col("digit")).alias("rank"),
            F.col("child").alias("digest"),
            F.concat("path", F.array(segment)).alias("path"),
        )
    return asked(entering(0) if at is None else at.unionByName(entering(0)), 0)


def proofs(held: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """(tree, rank, digest, subroot, path) of the leaves asked for, by default all; the path from the leaf up.

    ``wanted(tree, rank)`` names leaves by source and rank.
    """
    nothing = F.array().cast("array<struct<before:string,after:string>>")
    top = held.above.tops.withColumn("path", nothing)
    subroots = descend(top, held.above.levels).select(F.col("rank"), F.col("path"))
    starts = staged(held.names.select("rank", "tree", "digest", "height").join(subroots, "rank").drop("rank"), "starts")
    found = descend(starts, held.sources.levels, wanted)
    return found.select("tree", "rank", "digest", F.reverse("path").alias("path"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(path, leaf, lambda digest, step: digest_of(step["before"], digest, step["after"]))


def siblings_digest(path: Column) -> Column:
    """Digest of all siblings of a proof, from the leaf up and left to right."""
    return digest_of(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""))


def audited(docs: DataFrame, copy: Mapping[str, Column] | None = None) -> DataFrame:
    """Every row with its proof, and whether its copy still leads to the root."""
    held = manifest(docs, copy=copy)
    found = held.leaves.join(proofs(held).drop("digest"), ["tree", "rank"])
    named = found.join(small_side(held.names.select("tree", F.col("digest").alias("subroot")), SMALL), "tree")
    return named.select(
        "doc_id",
        "leaf",
        "subroot",
        F.lit(held.root).alias("root"),
        siblings_digest(F.col("path")).alias("proof_sha256"),
        folded(F.col("other"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
