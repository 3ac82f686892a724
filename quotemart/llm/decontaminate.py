"""Benchmark decontamination by a distributed positional inverted index.

The index holds one posting (document row, place, term) for every training word that is also a
benchmark word. Phrases are the windows of ``width`` consecutive words of each benchmark item. A
posting of an item's word at place ``i`` fixes where the item would have to start, its alignment;
lists of postings are adjusted by that offset, so that the words of one occurrence meet under one
alignment. For each window the lists of its rarest two terms are intersected first, which leaves few
alignments; their remaining words are then looked up in the index, and a run of found words that
covers a window is an exact match. With a slop, words may lie that many places beside their aligned
place, which gives proximity matches.

Built with DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemart.llm.common import fresh, small_side, staged

WIDTH = 10
# Words: runs of digits, ASCII letters and whatever is not ASCII.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Stands for the end of a document, so that every document has a posting; no word is empty.
END = ""
# Rows of a broadcast side: some 100 bytes each.
SMALL = 500_000


def words(text: Column) -> Column:
    """Words of a text in order, letters as they are; null has none."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def lowered(word: Column) -> Column:
    """A word with A to Z lower-cased and other letters left alone."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


@dataclass
class Items:
    """Benchmark items by word: ``places(item, place, term)``, ``windows(item, start, size, first, second)``."""

    places: DataFrame
    windows: DataFrame


@dataclass
class Index:
    """Postings ``(row, place, term)`` and documents ``(row, doc_id, n_words)``, both written tables."""

    postings: DataFrame
    documents: DataFrame


def vocabulary(items: DataFrame, text: str = "text") -> DataFrame:
    """(word, term) for every word of the items; terms count from 1, the end of a document is term 0."""
    found = items.select(F.explode(words(F.col(text))).alias("word")).select(lowered(F.col("word")).alias("word")).distinct()
    numbered = staged(found.withColumn("term", F.monotonically_increasing_id() + 1), "vocabulary")
    return numbered.union(items.sparkSession.range(1).select(F.lit(END), F.lit(0).cast("long")))


def build_index(docs: DataFrame, terms: DataFrame, text: str = "text", doc_id: str = "doc_id", row: str | None = None) -> Index:
    """Index every occurrence of the given terms in whole texts; one scan of the documents, no shuffle.

    ``row`` names a column that tells rows apart; without it rows are numbered as they are written,
    so that repeated ids stay apart.
    """
    number = F.col(row) if row else F.monotonically_increasing_id()
    # Rows are numbered below the explode, or else each of its rows would get a number.
    numbered = docs.select(number.alias("row"), F.col(doc_id).alias("doc_id"), F.concat(words(F.col(text)), F.array(F.lit(END))).alias("words"))
    found = numbered.select("row", "doc_id", F.posexplode("words").alias("place", "word")).withColumn("word", lowered(F.col("word")))
    kept = staged(
        found.join(small_side(terms, SMALL), "word").select(
            "row", "place", "term", F.when(F.col("term") == 0, F.col("doc_id")).alias("doc_id")
        ),
        "postings",
    )
    return Index(
        kept.where("term > 0").select("row", "place", "term"),
        kept.where("term = 0").select("row", "doc_id", F.col("place").cast("long").alias("n_words")),
    )


def cut_items(items: DataFrame, terms: DataFrame, index: Index, text: str = "text", item_id: str = "item_id", width: int = WIDTH) -> Items:
    """Items by word, and their windows with the places of the two terms with the fewest postings."""
    numbered = staged(
        items.select(F.monotonically_increasing_id().alias("item"), F.col(item_id).alias("item_id"), words(F.col(text)).alias("words"))
        .where(F.size("words") > 0)
        .select("item", "item_id", F.size("words").alias("size"), F.posexplode("words").alias("place", "word"))
        .withColumn("word", lowered(F.col("word")))
        .join(terms, "word")
        .select("item", "item_id", "size", "place", "term"),
        "items",
    )
    counted = index.postings.groupBy("term").count()
    placed = numbered.join(counted, "term", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    # A word at place p is in the windows that start from p - width + 1 to p, within the item.
    last = F.greatest(F.col("size") - width, F.lit(0))
    windows = (
        placed.withColumn("start", F.explode(F.sequence(F.greatest(F.col("place") - width + 1, F.lit(0)), F.least("place", last))))
        .groupBy("item", "start")
        .agg(
            F.least(F.first("size"), F.lit(width)).alias("size"),
            F.min("count").alias("fewest"),
            F.slice(F.sort_array(F.collect_list(F.struct("count", "place", "term"))), 1, 2).alias("rare"),
        )
        .where("fewest > 0")
        .select("item", "start", "size", F.col("rare")[0].alias("first"), F.element_at("rare", -1).alias("second"))
    )
    return Items(numbered.select("item", "item_id", "place", "term"), staged(windows, "windows"))


def matches(index: Index, items: Items, width: int = WIDTH, slop: int = 0) -> DataFrame:
    """(row, item, start, size): runs of words in documents of which every ``width`` (or a shorter item) match an item.

    With ``slop`` 0 these are exact phrases, and ``start`` is the place of the run's first word. With
    a larger one every word lies at most ``slop`` places from where the window's rarest term puts it.
    """
    pairs = items.windows.groupBy(
        "item", F.col("first.term").alias("t1"), F.col("first.place").alias("p1"), F.col("second.term").alias("t2"), F.col("second.place").alias("p2")
    ).agg(F.min("start").alias("low"), F.max(F.col("start") + F.col("size")).alias("high"))
    pairs = small_side(staged(pairs, "pairs"), SMALL)

    def around(place: str) -> Column:
        return F.explode(F.sequence(F.col(place) - slop, F.col(place) + slop)) if slop else F.col(place)

    one = index.postings.join(pairs, F.col("term") == F.col("t1")).select("row", "item", "p1", "p2", (F.col("place") - F.col("p1")).alias("at"), "low", "high")
    two = (
        index.postings.join(pairs, F.col("term") == F.col("t2"))
        .select("row", "item", "p1", "p2", (F.col("place") - F.col("p2")).alias("near"))
        .select("row", "item", "p1", "p2", around("near").alias("at"))
    )
    both = staged(
        one.join(two, ["row", "item", "p1", "p2", "at"], "left_semi")
        .groupBy("row", "item", "at")
        .agg(F.collect_set(F.struct("low", "high")).alias("spans")),
        "alignments",
    )
    probes = (
        both.select("row", "item", "at", F.explode("spans").alias("span"))
        .select("row", "item", "at", F.explode(F.sequence("span.low", F.col("span.high") - 1)).alias("i"))
        .distinct()
        .join(items.places.select("item", F.col("place").alias("i"), "term"), ["item", "i"])
        .withColumn("aligned", F.col("at") + F.col("i"))
    )
    probes = probes.select("row", "item", "at", "i", "term", around("aligned").alias("place"))
    rows = small_side(both.select("row").distinct(), SMALL)
    found = (
        index.postings.join(rows, "row", "left_semi")
        .join(probes, ["row", "place", "term"])
        .select("row", "item", "at", "i")
        .distinct()
    )
    # Found words in a row of consecutive places share the difference of place and rank.
    run = F.col("i") - F.row_number().over(Window.partitionBy("row", "item", "at").orderBy("i"))
    least = items.windows.groupBy("item").agg(F.min("size").alias("least"))
    return (
        found.withColumn("run", run)
        .groupBy("row", "item", "at", "run")
        .agg(F.min("i").alias("low"), F.count("*").alias("size"))
        .join(least, "item")
        .where("size >= least")
        .select("row", "item", (F.col("at") + F.col("low")).cast("long").alias("start"), "size")
    )


def hits(found: DataFrame, items: Items) -> DataFrame:
    """(row, n_hit, items): words covered by runs, each counted once, and the ids of the matching items as sorted text."""
    before = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        found.groupBy("row", "start")
        .agg(F.max(F.col("start") + F.col("size")).alias("end"))
        .withColumn("covered", F.coalesce(F.max("end").over(before), F.lit(0)))
        .groupBy("row")
        .agg(F.sum(F.greatest(F.col("end") - F.greatest("start", "covered"), F.lit(0))).alias("n_hit"))
    )
    names = items.places.groupBy("item").agg(F.first(F.col("item_id").cast("string")).alias("item_id"))
    ids = found.select("row", "item").distinct().join(names, "item").groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    return spans.join(ids, "row")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    width: int = WIDTH,
    slop: int = 0,
    row: str | None = None,
) -> DataFrame:
    """One row per document row: (row, doc_id, n_words, n_hit, items), ``items`` the sorted ids of items with matching windows.

    Null and empty texts have no words and no hits, wordless items no windows. Items with a null id
    hit words but are not listed; an id that several items have is listed once. Repeated rows give
    repeated rows, empty tables no rows or no hits; other columns play no part.
    """
    terms = vocabulary(benchmark, text)
    index = build_index(docs, terms, text, doc_id, row)
    items = cut_items(benchmark, terms, index, text, item_id, width)
    found = staged(matches(index, items, width, slop), "matches")
    return index.documents.join(hits(found, items), "row", "left").select(
        "row",
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH) -> DataFrame:
    """The documents without those that hold a window of any item, all columns as they came."""
    row = fresh(docs, "row")
    rows = staged(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    hit = contamination(rows, benchmark, text, doc_id, width=width, row=row).where("n_hit > 0").select(F.col("row").alias(row))
    return rows.join(hit, row, "left_anti").select(*docs.columns)
