"""Nearest neighbours by inner product with a permutation index.

A vector is represented by its nearest pivots in order. The pivots are the axes of several random
rotations, so that they lie evenly around any data. Each block of vectors has one inverted file for
each pivot, which says for each vector of the block in which band of ranks it has the pivot, if
among its nearest. A query reads the files of its own nearest pivots: what two lists of pivots share,
summed over the files, is their footrule distance subtracted from its greatest value. The share of a
block's vectors that is nearest by footrule is ranked anew by the exact inner product.

Before pivots are looked up, the vectors of a block get one more component that makes them all
equally long, and queries a zero there, so that the largest inner product is the smallest angle. That
component must be small, or all vectors have nearly the same pivots: a block holds vectors of one
band of lengths and is lengthened to its own greatest. Bands with few vectors share blocks that are
ranked in full.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotemart.llm.common import staged

K, EVERY = 20, 20
# Pivots, those of them that represent a vector, ranks in a band, and the share of a block that is ranked anew.
PIVOTS, NEAREST, BAND, SHARE, LEAST = 256, 128, 16, 0.05, 100
# Vectors and queries that one task compares at a time.
ROWS, QUERIES = 4096, 4096
# Lengths in a band differ by this factor at most; bands of fewer vectors have no block of their own.
STEP, DENSE = 1.1, 1024


def pivots(size: int, number: int = PIVOTS, seed: int = 1) -> np.ndarray:
    """Unit vectors, the axes of random rotations one after the other; the same in every task."""
    rng = np.random.default_rng([seed, size])
    turns = [np.linalg.qr(rng.normal(size=(size, size)))[0] for _ in range(-(-number // size))]
    return np.concatenate(turns)[:number]


def longer(vectors: np.ndarray, most: float) -> np.ndarray:
    """Vectors with a component that brings them all to length ``most``."""
    return np.column_stack([vectors, np.sqrt(np.maximum(most**2 - (vectors**2).sum(1), 0))])


def ordered(vectors: np.ndarray, marks: np.ndarray, nearest: int) -> np.ndarray:
    """The nearest pivots of each vector, in order; ties to the pivot that comes first."""
    return np.argsort(-(vectors @ marks.T), axis=1, kind="stable")[:, :nearest]


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors divided by the length of the longest of them, whose squares may exceed all doubles."""
    greatest = np.abs(vectors).max(1, keepdims=True)
    parts = vectors / greatest
    logs = np.log(greatest) + np.log((parts**2).sum(1, keepdims=True)) / 2
    return parts / np.sqrt((parts**2).sum(1, keepdims=True)) * np.exp(logs - logs.max())


def products(vectors: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Inner products; those beyond all doubles are infinite."""
    with np.errstate(over="ignore", invalid="ignore"):
        out = vectors @ vector
        odd = ~np.isfinite(out)
        if odd.any():
            # Sums whose parts exceed the doubles though the whole may not.
            out[odd] = (vectors[odd].astype(np.longdouble) * vector.astype(np.longdouble)).sum(1).astype(np.float64)
    return out


class Block:
    """The inverted files of a block of vectors."""

    def __init__(self, vectors: np.ndarray, most: float, number: int = PIVOTS, nearest: int = NEAREST, band: int = BAND):
        self.vectors = vectors
        self.marks = pivots(vectors.shape[1] + 1, number)
        self.nearest = min(nearest, len(self.marks))
        # What a pivot at a rank is worth: how many bands it lies above the first rank that isn't listed.
        self.worth = (-(-np.arange(self.nearest, 0, -1) // band)).astype(np.uint8)
        lists = ordered(longer(vectors, most), self.marks, self.nearest)
        posted = np.zeros((len(vectors), len(self.marks)), dtype=np.uint8)
        np.put_along_axis(posted, lists, self.worth[None], 1)
        self.files = np.ascontiguousarray(posted.T)

    def close(self, pivots_: np.ndarray) -> np.ndarray:
        """For each vector half of how far its footrule distance, in bands, from a list of pivots lies below the greatest."""
        total = np.zeros(len(self.vectors), dtype=np.uint16)
        step = 255 // int(self.worth[0])
        for at in range(0, self.nearest, step):
            files = self.files[pivots_[at : at + step]]
            np.minimum(files, self.worth[at : at + step, None], out=files)
            total += np.add.reduce(files, axis=0, dtype=np.uint8)
        return total

    def search(self, queries: np.ndarray, share: float = SHARE, least: int = LEAST) -> list[np.ndarray]:
        """Places of the vectors that are nearest to each query by footrule: a share of all, or ``least`` if that is more."""
        lists = ordered(np.column_stack([queries, np.zeros(len(queries))]), self.marks, self.nearest)
        count = max(int(np.ceil(share * len(self.vectors))), least)
        if count >= len(self.vectors):
            return [np.arange(len(self.vectors))] * len(queries)
        return [np.argpartition(-self.close(x).astype(np.int32), count - 1)[:count] for x in lists]


def compared(rows: pd.DataFrame, queries: pd.DataFrame, k: int, share: float, least: int) -> pd.DataFrame:
    """The best ``k`` of a block's vectors for each query of a block of queries, by exact inner product.

    Blocks with odd numbers of parts hold lengths of all kinds: all their vectors are ranked.
    """
    out: list[pd.DataFrame] = []
    if len(rows) and len(queries):
        vectors = np.stack(rows["vector"].to_numpy()).astype(np.float64)
        asked = np.stack(queries["asked"].to_numpy()).astype(np.float64)
        ids = rows["vec_id"].to_numpy(np.int64)
        if rows["part"].iloc[0] % 2:
            found = [np.arange(len(vectors))] * len(asked)
        else:
            found = Block(scaled(vectors), 1.0).search(asked / np.abs(asked).max(1, keepdims=True), share, least)
        for query, vector, places in zip(queries["query_id"].to_numpy(np.int64), asked, found, strict=True):
            places = places[ids[places] != query]
            scores = products(vectors[places], vector)
            best = np.lexsort((ids[places], -scores))[:k]
            out.append(pd.DataFrame({"query_id": query, "vec_id": ids[places][best], "score": scores[best]}))
    empty = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
    return pd.concat([empty, *out], ignore_index=True) if out else empty


def valid(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, vector): what takes part, one row for each id.

    Null ids, and vectors that are null, empty, zero or hold a null, a NaN or an infinity take no
    part. Of rows with equal ids that with the greatest vector in array order counts.
    """
    v = F.col("vector")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (
        vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
        .where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(v, lambda x: x != 0))
        .groupBy("vec_id")
        .agg(F.max("vector").alias("vector"))
    )


def search(
    vectors: DataFrame, k: int = K, every: int = EVERY, share: float = SHARE, least: int = LEAST, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` vectors found nearest to each whose id is divisible by ``every``.

    All vectors are indexed and compared with every query of the same number of components, in blocks
    of both, so that a task's memory doesn't grow with the tables; the query itself is no candidate.
    Scores are exact, infinite beyond all doubles; ties go to the smaller id; a query with fewer
    candidates gets all of them.
    """
    # Components are divided by the greatest before they are squared: no square exceeds the doubles.
    greatest = F.array_max(F.transform("vector", F.abs))
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + (x / F.col("greatest")) * (x / F.col("greatest")))
    band = F.floor((F.log("greatest") + F.log(squares) / 2) / float(np.log(STEP)) + 0.5).cast("int")
    rows = valid(vectors, vec_id, vector).withColumn("size", F.size("vector")).withColumn("greatest", greatest).withColumn("band", band)
    rows = staged(rows.drop("greatest"), "vectors")
    # One row for each number of components and band that occurs; doubles have some 15,000 bands.
    bands = rows.groupBy("size", "band").agg(F.count("*").alias("n"), F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("asked"))
    bands = bands.withColumn("sparse", F.when(F.col("n") < DENSE, F.col("n")).otherwise(0))
    before = F.sum("sparse").over(Window.partitionBy("size").orderBy("band")) - F.col("sparse")
    # A band of its own has an even number; sparse bands are put together to some ``ROWS`` vectors and have odd ones.
    part = F.when(F.col("sparse") == 0, F.col("band") * 2).otherwise(F.floor(before / ROWS).cast("int") * 2 + 1)
    blocks = F.when(F.col("sparse") == 0, F.ceil(F.col("n") / ROWS).cast("int")).otherwise(1)
    asking = F.ceil(F.sum("asked").over(Window.partitionBy("size")) / QUERIES).cast("int")
    bands = bands.select("size", "band", part.alias("part"), blocks.alias("blocks"), asking.alias("asking")).where("asking > 0")
    sized = rows.join(F.broadcast(bands), ["size", "band"])
    every_block = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own_block = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    candidates = sized.select("size", "part", own_block("blocks").alias("block"), every_block("asking").alias("asking_block"), "vec_id", "vector")
    # All blocks of a number of components, for its queries.
    places = bands.select("size", "part", every_block("blocks").alias("block")).groupBy("size").agg(F.collect_set(F.struct("part", "block")).alias("places"))
    queries = (
        sized.where(F.col("vec_id") % every == 0)
        .join(F.broadcast(places), "size")
        .select(
            F.col("size").alias("like"),
            F.explode("places").alias("beside"),
            own_block("asking").alias("asking_beside"),
            F.col("vec_id").alias("query_id"),
            F.col("vector").alias("asked"),
        )
        .select("like", F.col("beside.part").alias("part_beside"), F.col("beside.block").alias("beside"), "asking_beside", "query_id", "asked")
    )
    found = (
        candidates.groupBy("size", "part", "block", "asking_block")
        .cogroup(queries.groupBy("like", "part_beside", "beside", "asking_beside"))
        .applyInPandas(lambda a, b: compared(a, b, k, share, least), "query_id long, vec_id long, score double")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
