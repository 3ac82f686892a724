"""How far the sources of a language diverge in their words, from joint tables by one-hot level products.

A group is a language and a source. For a block of a language's terms, each group has an indicator
column for every count that a term of the block reaches in it, none included: the column's rows say
which terms have that count. The matrix of these columns, multiplied by its transpose, holds for any
two groups and any two counts how many terms have the one in the one group and the other in the
other: their joint table. Tables of blocks add up. Whatever depends on a term by its two counts only
is priced from the tables, so no pair of groups visits the terms again.

Products are of zeros and ones in single precision, which counts up to 2^24 exactly; a block has
fewer rows. Blocks hold terms of like totals: rare terms have few counts, so many share a block,
frequent ones have many, so a block has few. Blocks are the unit of work, whatever source or language
they come from. All prices are integers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemart.llm.common import small_side, staged

LEAST_DOCS, UNIT, RANKS = 3, 1_000_000_000, 200
# A block has 2^18 / total rows for terms of that total, within these bounds, and so many cells at most.
WORK, MOST_ROWS, LEAST_ROWS, CELLS = 18, 4096, 16, 1 << 22
# Indicator columns multiplied at a time.
PANEL = 1024
# Counted words held by a map task before they are handed on.
HELD = 1 << 19
# Rows of a broadcast side: a few names and numbers.
SMALL = 500_000

# Words are runs of ASCII letters and whatever is not ASCII; A to Z are lower-cased.
LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


@dataclass
class Corpus:
    """``groups(lang, source, number, words)``, ``langs(lang, width, terms, words)``, ``terms(lang, term, total, held)``.

    ``number`` counts a language's groups from 0, ``held`` lists (number, count) of the groups that
    have the term, ``words`` are occurrences of kept terms, ``width`` is the number of groups and
    ``terms`` that of kept terms.
    """

    groups: DataFrame
    langs: DataFrame
    terms: DataFrame


def words(text: str) -> list[bytes]:
    """Terms of a text in order, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(LETTERS).split()


def counted(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of every group: occurrences, and documents that have the term."""

    def handed(held: dict) -> pd.DataFrame:
        rows = [
            (lang, source, term.decode("utf-8", "replace"), n, docs[term])
            for (lang, source), (count, docs) in held.items()
            for term, n in count.items()
        ]
        return pd.DataFrame(rows, columns=["lang", "source", "term", "n", "docs"])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        added = 0
        for batch in batches:
            for lang, source, text in zip(batch["lang"], batch["source"], batch["text"], strict=True):
                found = words(text)
                if not found:
                    continue
                total, docs = held.setdefault((lang, source), (Counter(), Counter()))
                before = len(total)
                total.update(found)
                docs.update(set(found))
                added += len(total) - before
                if added >= HELD:
                    yield handed(held)
                    held, added = {}, 0
        if held:
            yield handed(held)

    parts = docs.mapInPandas(count, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def corpus(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST_DOCS) -> Corpus:
    """Count a table of documents; null text, language and source count as empty.

    A term is kept for a language if at least ``least`` of its documents have it.
    """
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((text, "text"), (lang, "lang"), (source, "source"))))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    numbered = staged(rows.select("lang", "source").distinct().withColumn("number", place), "groups")
    found = counted(rows).join(small_side(numbered, SMALL), ["lang", "source"])
    terms = staged(
        found.groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("number", "n")).alias("held"))
        .where(F.col("docs") >= least)
        .select("lang", "term", "total", "held"),
        "terms",
    )
    sums = terms.select("lang", F.inline("held")).groupBy("lang", "number").agg(F.sum("n").alias("words"))
    groups = numbered.join(sums, ["lang", "number"], "left").select("lang", "source", "number", F.coalesce("words", F.lit(0)).alias("words"))
    widths = numbered.groupBy("lang").agg(F.count("*").alias("width"))
    kept = terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("words"))
    langs = widths.join(kept, "lang", "left").na.fill(0, ["terms", "words"])
    return Corpus(staged(groups, "groups"), staged(langs, "langs"), terms)


def share(count: Column, words: Column, terms: Column) -> Column:
    """A term's smoothed share of a group's words in units of 1 / 1,000,000,000, from 1."""
    one, all_ = F.lit(UNIT).cast("long"), words + terms
    quick = F.call_function("div", F.try_multiply(one, count + 1), all_)
    exact = F.call_function("div", one.cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)"), all_.cast("decimal(20,0)"))
    return F.coalesce(quick, exact) + 1


def price(p: Column, q: Column) -> Column:
    """The squared difference of two shares over the second, rounded down."""
    return F.call_function("div", (p - q) * (p - q), q)


def product(counts: np.ndarray) -> pd.DataFrame:
    """Joint tables of a block: (left, a, right, b, n) for its groups, ``left`` before ``right``.

    ``counts`` holds a row for each term and a column for each group.
    """
    rows, width = counts.shape
    levels, codes, edges = [], np.empty_like(counts), [0]
    for g in range(width):
        values, codes[:, g] = np.unique(counts[:, g], return_inverse=True)
        codes[:, g] += edges[-1]
        levels.append(values)
        edges.append(edges[-1] + len(values))
    group = np.repeat(np.arange(width), np.diff(edges))
    level = np.concatenate(levels)
    indicators = np.zeros((rows, edges[-1]), dtype=np.float32)
    np.put_along_axis(indicators, codes, 1, axis=1)
    parts = []
    for start in range(0, edges[-1], PANEL):
        joint = indicators[:, start : start + PANEL].T @ indicators
        x, y = np.nonzero(joint)
        n, x = joint[x, y].astype(np.int64), x + start
        apart = group[x] < group[y]
        x, y = x[apart], y[apart]
        parts.append(pd.DataFrame({"left": group[x], "a": level[x], "right": group[y], "b": level[y], "n": n[apart]}))
    return pd.concat(parts)


def joint_tables(held: Corpus) -> DataFrame:
    """(lang, left, a, right, b, n): joint tables of all blocks, to be added up; groups go by their numbers."""
    size = F.greatest(
        F.lit(1),
        F.least(
            F.greatest(F.lit(LEAST_ROWS), F.least(F.lit(MOST_ROWS), F.expr(f"shiftleft(1L, greatest(0, {WORK} - class))"))),
            F.expr(f"{CELLS} div width"),
        ),
    )
    tiers = held.terms.select("lang", "term", "held", F.floor(F.log2("total")).cast("int").alias("class"))
    # A row for each language and power of two.
    blocks = tiers.groupBy("lang", "class").agg(F.count("*").alias("n")).join(held.langs.select("lang", "width"), "lang")
    blocks = blocks.select("lang", "class", "width", F.ceil(F.col("n") / size).alias("blocks"))
    dealt = tiers.join(small_side(blocks, SMALL), ["lang", "class"]).select(
        "lang", "class", F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"), "width", F.col("held.number").alias("number"), F.col("held.n").alias("n")
    )

    def multiplied(rows: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros((len(rows), int(rows["width"].iloc[0])), dtype=np.int64)
        sizes = [len(x) for x in rows["number"]]
        counts[np.repeat(np.arange(len(rows)), sizes), np.concatenate(rows["number"].tolist())] = np.concatenate(rows["n"].tolist())
        return product(counts).assign(lang=rows["lang"].iloc[0])

    return dealt.groupBy("lang", "class", "block").applyInPandas(multiplied, "left int, a long, right int, b long, n long, lang string")


def _total(n: str, value: Column) -> Column:
    return F.sum(F.col(n).cast("decimal(10,0)") * value.cast("decimal(20,0)")).cast("long")


def pairs(held: Corpus) -> DataFrame:
    """(lang, source, item, value): each group against every other of its language, summed over all kept terms."""

    def named(side: str) -> DataFrame:
        return small_side(held.groups.select("lang", F.col("number").alias(side), F.col("words").alias(f"{side}_words")), SMALL)

    terms = small_side(held.langs.select("lang", "terms"), SMALL)
    tables = joint_tables(held).join(named("left"), ["lang", "left"]).join(named("right"), ["lang", "right"]).join(terms, "lang")
    p, q = share(F.col("a"), F.col("left_words"), F.col("terms")), share(F.col("b"), F.col("right_words"), F.col("terms"))
    priced = tables.select("lang", "left", "right", "n", p.alias("p"), q.alias("q"))
    sums = priced.groupBy("lang", "left", "right").agg(
        _total("n", price(F.col("p"), F.col("q"))).alias("there"), _total("n", price(F.col("q"), F.col("p"))).alias("back")
    )
    both = sums.select("lang", "left", "right", F.col("there").alias("value")).unionByName(
        sums.select("lang", F.col("right").alias("left"), F.col("left").alias("right"), F.col("back").alias("value"))
    )
    x = held.groups.select("lang", "source", F.col("number").alias("left"))
    y = held.groups.select("lang", F.col("source").alias("item"), F.col("number").alias("right"))
    every = x.join(y, "lang").where(F.col("left") != F.col("right"))
    return every.join(both, ["lang", "left", "right"], "left").select("lang", "source", "item", F.coalesce("value", F.lit(0)).alias("value"))


def terms_above(held: Corpus) -> DataFrame:
    """(lang, source, item, value): each kept term that a group has and uses more than its language does."""
    sizes = small_side(held.groups.select("lang", "number", "source", F.col("words").alias("group_words")), SMALL)
    langs = small_side(held.langs.select("lang", "terms", F.col("words").alias("lang_words")), SMALL)
    found = held.terms.select("lang", "term", "total", F.inline("held")).join(sizes, ["lang", "number"]).join(langs, "lang")
    p, q = share(F.col("n"), F.col("group_words"), F.col("terms")), share(F.col("total"), F.col("lang_words"), F.col("terms"))
    return (
        found.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
        .where("p > q")
        .select("lang", "source", "item", price(F.col("p"), F.col("q")).alias("value"))
    )


def audited(docs: DataFrame, ranks: int = RANKS) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` with all ranks, part ``term`` with the first ``ranks``.

    Null text, language and source count as empty, so null and empty sources are one group. Whole
    texts count, however long; repeated rows count as often as they occur. Equal values are ranked by
    item, bytewise. A language without kept terms has pairs of value 0, one with a single source has
    none; an empty table gives no rows; other columns play no part.
    """
    held = corpus(docs)
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    whole = pairs(held).withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
    # Spark cuts groups to this many rows in the map tasks.
    first = terms_above(held).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks).withColumn("part", F.lit("term"))
    return whole.unionByName(first).select("lang", "source", "part", "item", "value", "rank")
