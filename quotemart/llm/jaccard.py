"""Exact n-gram Jaccard join by adaptive multi-match prefixes.

A document is the set of its distinct word shingles; two documents link when their sets' Jaccard
similarity reaches ``percent``. Sets are ordered by rising frequency of their shingles. With T the
fewest shingles that a set of n must share with any partner, the first ``n - T + l`` shingles of both
partners hold at least ``l`` common ones. Each document chooses its ``l`` by estimated cost, reading
the lists of a longer prefix against verifying the candidates that share at least ``l``; two
documents that chose ``l`` and ``m`` are verified only if their prefixes share ``min(l, m)``.

* A set that has too many shingles of its own has a prefix of such shingles only, which meets nobody.
  These sets are told first: hashes of all shingles travel in packed arrays, one array for each chunk
  of texts and hash range, a chunk names a shingle once however often it holds it, and the answer is
  how many of a document's shingles occur nowhere else. A lost answer would only keep a set longer.
* In a list, every member first meets one hub, that with the fewest shingles of its own, then in a
  second round one chosen by hash; verified stars are joined to classes. After that only members of
  different classes meet, and the largest class of a list meets the others alone, so a group of near
  copies costs links in proportion to its members. ``links`` returns all pairs.
* Members of a list that are alike but not enough are told apart before they make a pair: no more can
  be shared than either has in common with anybody, and a set's signature flips one bit for each
  shingle, so that signatures differ in no more bits than sets do in shingles.

Shingles are told by 64-bit hashes, sets by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemart.llm.common import slices, small_side, staged
from quotemart.llm.components import components

WORDS, PERCENT = 5, 80
# Choices of l, and what moving and comparing one shingle costs against reading one place of a list.
MOST, COMPARE = 16, 0.125
# Shingles of a hash range: about the first number, and more once there are that many ranges.
RANGE, RANGES, LARGE_RANGE = 1 << 20, 1 << 12, 1 << 26
# Texts of a chunk, in bytes: the first number, or so many for each range.
CHUNK, CHUNK_PER_RANGE = 8 << 20, 384
# Bits of a signature, in longs.
LONGS = 16
# Rows of a broadcast side hold two digests of 32 characters.
SMALL = 100_000


def _factors(words: int) -> np.ndarray:
    """An odd factor for each place of a shingle, and a start for each number of words."""
    return np.array([xxhash.xxh64_intdigest(f"place {k}", 42) | 1 for k in range(2 * words + 1)], dtype=np.uint64)


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; words are cut at ASCII white space after lower-casing A to Z.

    A text of fewer words is one shingle, a text of none has none.
    """
    factors = _factors(words)
    found = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]
    sizes = np.array([len(f) for f in found], dtype=np.int64)
    flat = np.fromiter((h for f in found for h in map(xxhash.xxh64_intdigest, f)), dtype=np.uint64, count=int(sizes.sum()))
    # Windows over the whole batch; those that cross from one text to the next are never taken.
    whole = np.zeros(max(len(flat) - words + 1, 0), dtype=np.uint64)
    for k in range(words):
        whole += flat[k : k + len(whole)] * factors[k]
    out, at = [], 0
    for size in sizes.tolist():
        if size >= words:
            values = whole[at : at + size - words + 1] + factors[2 * words]
        elif size:
            values = np.sum(flat[at : at + size] * factors[:size], keepdims=True, dtype=np.uint64) + factors[words + size]
        else:
            values = flat[:0]
        values = (values ^ (values >> np.uint64(32))) * factors[0]
        out.append(np.unique(values ^ (values >> np.uint64(29))))
        at += size
    return out


def signature(hashes: np.ndarray) -> np.ndarray:
    """A bit for each of the hash classes, flipped by every member of the set."""
    counts = np.bincount((hashes >> np.uint64(7)).astype(np.int64) % (64 * LONGS), minlength=64 * LONGS)
    return np.packbits(counts.astype(np.uint8) & 1).view(np.int64)


def set_rows(texts: list[str], words: int) -> pd.DataFrame:
    """(n, tokens, bits) of each text."""
    sets = shingle_sets(texts, words)
    return pd.DataFrame({"n": [len(s) for s in sets], "tokens": [s.view(np.int64) for s in sets], "bits": [signature(s) for s in sets]})


def sized(text: Column, words: int = WORDS) -> Column:
    """(n, digest) of a text: the size of its set, and 128 bits that tell the set."""

    @F.pandas_udf("n long, digest string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for a, b in slices([len(t or "") for t in texts]):
                rows += [(len(s), xxhash.xxh3_128_hexdigest(s.tobytes())) for s in shingle_sets(texts.iloc[a:b].tolist(), words)]
            yield pd.DataFrame(rows, columns=["n", "digest"])

    return of(text)


def _ranges(total: int) -> int:
    """Number of hash ranges for so many shingles."""
    return max(1, -(-total // LARGE_RANGE), min(-(-total // RANGE), RANGES))


def _spread(docs: pd.DataFrame, chunk: int, ranges: int, words: int) -> pd.DataFrame:
    """One chunk's rows: its shingles for each range, and its documents under a range past the last."""
    sets = shingle_sets(docs["text"].tolist(), words)
    sizes = [len(s) for s in sets]
    flat = np.concatenate([np.zeros(0, dtype=np.uint64), *sets])
    owner = np.repeat(np.arange(len(sets), dtype=np.uint32), sizes)
    place = (flat >> np.uint64(32)) % np.uint64(ranges)
    order = np.lexsort((flat, place))
    flat, owner, place = flat[order], owner[order], place[order]
    first = np.ones(len(flat), dtype=bool)
    first[1:] = flat[1:] != flat[:-1]
    # A shingle of several documents of the chunk is sent once and needs no answer.
    shared = np.zeros(len(flat), dtype=bool)
    shared[:-1] = ~first[1:]
    shared |= ~first
    edges = np.searchsorted(place, np.arange(ranges + 1))
    rows = []
    for k in np.flatnonzero(np.diff(edges)):
        cut = slice(edges[k], edges[k + 1])
        alone = ~shared[cut]
        low = flat[cut].astype(np.uint32)
        common = low[shared[cut] & first[cut]]
        # Kept in the order of documents, so that their numbers compress.
        by = np.argsort(owner[cut][alone], kind="stable")
        rows.append((int(k), chunk, low[alone][by].tobytes(), owner[cut][alone][by].tobytes(), common.tobytes()))
    names = "\n".join(f"{key} {size}" for key, size in zip(docs["key"], sizes, strict=True)).encode()
    rows.append((ranges + chunk % ranges, chunk, names, b"", b""))
    return pd.DataFrame(rows, columns=["place", "chunk", "alone", "owner", "common"])


def _answered(rows: pd.DataFrame, ranges: int) -> pd.DataFrame:
    """How many shingles of this range each document of each chunk has that no other document has."""
    if not len(rows) or rows["place"].iloc[0] >= ranges:
        return rows[["chunk", "alone", "owner"]].assign(names=True)
    alone = [np.frombuffer(b, dtype=np.uint32) for b in rows["alone"]]
    sizes = [len(a) for a in alone]
    own = np.concatenate(alone)
    values, counts = np.unique(np.concatenate([own, *(np.frombuffer(b, dtype=np.uint32) for b in rows["common"])]), return_counts=True)
    dead = counts[np.searchsorted(values, own)] == 1
    out, at = [], 0
    for chunk, size, owner in zip(rows["chunk"], sizes, rows["owner"], strict=True):
        docs, n = np.unique(np.frombuffer(owner, dtype=np.uint32)[dead[at : at + size]], return_counts=True)
        out.append((chunk, docs.tobytes(), n.astype(np.uint32).tobytes(), False))
        at += size
    return pd.DataFrame(out, columns=["chunk", "alone", "owner", "names"])


def _candidates(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Keys of a chunk's documents that share enough shingles with others, as far as counts can tell."""
    keys: list[str] = []
    for names in rows["alone"][rows["names"]]:
        pairs = [line.split(" ") for line in bytes(names).decode().split("\n")]
        sizes = np.array([int(n) for _, n in pairs], dtype=np.int64)
        dead = np.zeros(len(pairs), dtype=np.int64)
        for docs, n in zip(rows["alone"][~rows["names"]], rows["owner"][~rows["names"]], strict=True):
            dead[np.frombuffer(docs, dtype=np.uint32)] += np.frombuffer(n, dtype=np.uint32)
        keys += [pairs[k][0] for k in np.flatnonzero((sizes > 0) & ((sizes - dead) * 100 >= sizes * percent))]
    return pd.DataFrame({"key": pd.Series(keys, dtype="object")})


def candidates(texts: DataFrame, total: int, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Keys of the texts of which at least ``percent`` of the shingles occur in some other row.

    ``texts(key, text)`` may repeat keys; ``total`` is about the sum of set sizes and decides the
    number of hash ranges.
    """
    ranges = _ranges(total)
    chunk_bytes = max(CHUNK, CHUNK_PER_RANGE * ranges)

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, number = TaskContext.get().partitionId(), 0
        held, size = [], 0
        for batch in batches:
            for a, b in slices([len(t or "") for t in batch["text"]]):
                held.append(batch.iloc[a:b])
                size += sum(len(t or "") for t in held[-1]["text"])
                if size >= chunk_bytes:
                    yield _spread(pd.concat(held), (task << 32) + number, ranges, words)
                    held, size, number = [], 0, number + 1
        if held:
            yield _spread(pd.concat(held), (task << 32) + number, ranges, words)

    packed = texts.mapInPandas(spread, "place long, chunk long, alone binary, owner binary, common binary")
    answers = packed.groupBy("place").applyInPandas(
        lambda rows: _answered(rows, ranges), "chunk long, alone binary, owner binary, names boolean"
    )
    return answers.groupBy("chunk").applyInPandas(lambda rows: _candidates(rows, percent), "key string")


def cheapest(frequencies: np.ndarray, n: int, need: int) -> int:
    """The l whose prefix costs least: places read, and candidates with at least l matches compared in full.

    ``frequencies`` are those of the set's shared shingles in order; ``need`` of the set's ``n``
    shingles must be shared. At most places / l candidates can have l matches.
    """
    choices = np.arange(1, min(MOST, need) + 1)
    places = np.cumsum(frequencies - 1)[len(frequencies) - need + choices - 1]
    return int(choices[np.argmin(places + places / choices * n * COMPARE)])


def postings(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(token, id, n, live, pos, l): the shingles of each set's chosen prefix that other sets have too.

    ``live`` of a set's shingles occur in others; ``pos`` counts from 1 in the set's order by
    frequency and hash. ``sets(id, n, tokens)`` holds different sets, as a written table.
    """
    exploded = sets.select("id", "n", F.explode("tokens").alias("token"))
    counted = exploded.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    live = exploded.join(counted, "token").groupBy("id", "n").agg(F.collect_list(F.struct("df", "token")).alias("live"))

    def posted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for i, n, df, token in zip(batch["id"], batch["n"], batch["df"], batch["token"], strict=True):
                need = -(-n * percent // 100)
                if len(df) < need:
                    continue
                order = np.lexsort((token, df))
                df, token = df[order], token[order]
                chosen = cheapest(df, n, need)
                kept = token[: len(df) - need + chosen]
                place = n - len(df) + 1 + np.arange(len(kept))
                parts.append(pd.DataFrame({"token": kept, "id": i, "n": n, "live": len(df), "pos": place, "l": chosen}))
            if parts:
                yield pd.concat(parts)

    return live.select("id", "n", F.col("live.df").alias("df"), F.col("live.token").alias("token")).mapInPandas(
        posted, "token long, id long, n long, live long, pos long, l long"
    )


def _meet(left: DataFrame, right: DataFrame, also: Column, percent: int, signed: bool = False) -> DataFrame:
    """(a, b), a < b, of which the prefixes share as many tokens as both chose, whatever side they came from.

    A common token counts only if both sets together could still share enough; the first ``min(l)``
    common tokens of a linked pair always do. ``signed`` rows hold signatures, too.
    """
    x, y = left.alias("x"), right.alias("y")
    both = F.col("x.n") + F.col("y.n")
    least = F.least("x.l", "y.l")
    # Common tokens before this one are shared with others, and it counts as one of the first min(l).
    before = F.least(least - 1, F.col("x.pos") - 1 - F.col("x.n") + F.col("x.live"), F.col("y.pos") - 1 - F.col("y.n") + F.col("y.live"))
    most = before + 1 + F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    alike = (F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * percent) & (most * (100 + percent) >= both * percent)
    if signed:
        apart = reduce(Column.__add__, (F.bit_count(F.col("x.bits")[k].bitwiseXOR(F.col("y.bits")[k])) for k in range(LONGS)))
        alike = alike & (apart * (100 + percent) <= both * (100 - percent))
    return (
        x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.id") != F.col("y.id")) & also & alike)
        .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"), least.alias("l"))
        .groupBy("a", "b")
        .agg(F.count("*").alias("common"), F.min("l").alias("l"))
        .where("common >= l")
        .select("a", "b")
    )


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b, shared): the pairs whose whole sets are similar enough."""
    first = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    second = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    shared = F.size(F.array_intersect("ta", "tb"))
    return (
        pairs.join(first, "a")
        .join(second, "b")
        .select("a", "b", "na", "nb", shared.alias("shared"))
        .where(F.col("shared") * 100 >= percent * (F.col("na") + F.col("nb") - F.col("shared")))
        .select("a", "b", "shared")
    )


def links(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b, shared): every pair of different sets that link; ``sets(id, n, tokens, bits)`` is a written table."""
    posts = staged(postings(sets, percent).join(sets.select("id", "bits"), "id"), "postings")
    return verified(_meet(posts, posts, F.col("x.id") < F.col("y.id"), percent, True), sets, percent)


def _stars(posts: DataFrame, order: list[Column], sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): verified links of each list's members to its first member by ``order``; ``posts`` may hold classes."""
    columns = [c for c in posts.columns if c != "token"]
    hubs = (
        posts.groupBy("token")
        .agg(F.count("*").alias("members"), F.min(F.struct(*(o.alias(f"o{k}") for k, o in enumerate(order)), *columns)).alias("hub"))
        .where("members > 1")
        .select("token", *(F.col(f"hub.{c}").alias(c) for c in columns))
    )
    other = F.col("x.class") != F.col("y.class") if "class" in columns else F.lit(True)
    return verified(_meet(posts, hubs, other, percent), sets, percent).select("a", "b")


def _open(posts: DataFrame, found: DataFrame) -> DataFrame:
    """Lists that still hold several classes: postings with their class and the class with the most members."""
    hung = posts.select("token", "id", "n", "live", "pos", "l").join(components(found), F.col("id") == F.col("node"), "left")
    labelled = staged(hung.select("token", "id", "n", "live", "pos", "l", F.coalesce("root", "id").alias("class")), "labelled")
    mixed = (
        labelled.groupBy("token", "class")
        .agg(F.count("*").alias("members"))
        .groupBy("token")
        .agg(F.count("*").alias("classes"), F.max(F.struct("members", "class")).alias("most"))
        .where("classes > 1")
        .select("token", F.col("most.class").alias("major"))
    )
    return staged(labelled.join(mixed, "token"), "open")


def class_links(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b): links that join the same classes as all links do; ``sets(id, n, tokens, bits)`` is a written table."""
    posts = staged(postings(sets, percent), "postings")
    by_hash = F.xxhash64("id")
    found = staged(_stars(posts, [F.col("n") - F.col("live"), by_hash], sets, percent), "stars")
    posts = _open(posts, found)
    found = staged(found.union(_stars(posts.drop("major"), [by_hash], sets, percent)), "stars")
    posts = _open(posts, found).join(sets.select("id", "bits"), "id")
    posts = staged(posts, "signed")
    across = (F.col("x.class") != F.col("y.class")) & ((F.col("y.class") == F.col("y.major")) | (F.col("x.id") < F.col("y.id")))
    rest = verified(_meet(posts.where("class <> major"), posts, across, percent, True), sets, percent)
    return found.union(rest.select("a", "b"))


def classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: its id, the size of its set, and its class's smallest document id.

    Null, empty and wordless texts have empty sets, which link with nothing, not with each other
    either. Whole texts count, however long. Documents with equal sets are one class. Null ids are
    passed over; a class of null ids only has a null. Repeated rows give repeated rows; an empty
    table gives no rows; columns other than id and text play no part.
    """
    given = docs.select(F.col(doc_id).alias("doc_id"), F.md5(F.col(text).cast("binary")).alias("key"), F.col(text).alias("text"))
    rows = staged(given.select("doc_id", "key", sized(F.col("text"), words).alias("set")).select("doc_id", "key", "set.n", "set.digest"), "sized")
    total = rows.agg(F.sum("n")).first()[0] or 0
    keys = candidates(given.where("text IS NOT NULL").select("key", "text"), total, words, percent).distinct()
    # One text for each set.
    chosen = staged(rows.where("n > 0").select("key", "digest").distinct().join(keys, "key").groupBy("digest").agg(F.min("key").alias("key")), "chosen")
    texts = given.join(small_side(chosen, SMALL), "key").groupBy("key", "digest").agg(F.first("text").alias("text"))

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b in slices([len(t) for t in batch["text"]]):
                part = batch.iloc[a:b]
                yield set_rows(part["text"].tolist(), words).assign(digest=part["digest"].tolist())

    sets = staged(
        texts.mapInPandas(hashed, "n long, tokens array<long>, bits array<long>, digest string").withColumn("id", F.monotonically_increasing_id()), "sets"
    )
    hung = components(class_links(sets.select("id", "n", "tokens", "bits"), percent))
    named = sets.select("id", "digest").join(hung, F.col("id") == F.col("node"), "left").select("digest", F.coalesce("root", "id").alias("root"))
    lows = rows.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("low")).join(named, "digest", "left")
    firsts = lows.where("root IS NOT NULL").groupBy("root").agg(F.min("low").alias("first"))
    found = lows.join(firsts, "root", "left").select("digest", F.coalesce("first", "low").alias("first"))
    return rows.join(found, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("first")).otherwise(F.col("doc_id")).alias("component_id")
    )
