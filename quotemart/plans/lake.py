"""The lake's bars: kept by trading day, brought up to date from new landing files only.

A bar's place in the landing files stays with it, so the first bar of a ticker and time can be told
again when more files come: a day's new content follows from its old content and the new bars alone.
A ledger holds each file's size, time and days. A file that changed or went may have hidden bars of
others; then all files of its days are read again and these days are built from them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from quotemart.functions.calendar import day_key
from quotemart.operators.dedup import keep_first
from quotemart.schemas import SCHEMAS
from quotemart.sinks.daytable import Conflict, DayTable
from quotemart.sinks.fact import spread
from quotemart.sinks.store import Store
from quotemart.sources import files
from quotemart.sources.landing import (
    ARRAYS,
    LINES,
    bar_feed,
    broken_files,
    landing_lines,
    landing_texts,
    line_records,
    records,
    unreadable,
)

DAY, LEDGER = "trading_day", "bar_files"
# Bars without a time are kept, too.
NO_DAY = 0
_PLACE = [
    StructField("millis", LongType()),
    StructField("file", StringType()),
    StructField("pos", IntegerType()),
    StructField(DAY, IntegerType()),
]
KEPT_SCHEMA = StructType([*SCHEMAS["bars"].fields, *_PLACE])
# Equal bars have the same key; the one with the first place counts.
KEY, PLACE = [DAY, "ticker", "millis"], ["file", "pos"]
# A bar takes some 200 bytes in a sort: about 400 MB per task.
BARS_PER_TASK = 2_000_000
# Parts of a day whose sizes tell whether a bar has too many repeats.
PARTS = 64


def bar_table(spark: SparkSession, lake: str) -> DayTable:
    """The bars of a lake by trading day, with their places in the landing files."""
    return DayTable(spark, f"{lake}/bars_by_day", DAY, KEPT_SCHEMA)


def dated(feed: DataFrame) -> DataFrame:
    """A bar feed with the trading day of each bar."""
    return feed.withColumn(DAY, F.coalesce(day_key(F.to_date("timestamp")), F.lit(NO_DAY))).select(*KEPT_SCHEMA.names)


def first_of(bars: DataFrame) -> DataFrame:
    """The first bar of every ticker and raw millisecond in file order; equal times lie on one day."""
    return keep_first(bars, KEY, [F.col(c) for c in PLACE])


def part_of(count: int) -> Column:
    """Which of so many parts of a day a bar belongs to; a ticker's bars are in one."""
    return F.pmod(F.hash("ticker"), F.lit(count))


def first_by_day(bars: DataFrame, tasks: int, slices: int) -> DataFrame:
    """The first bars, gathered for the write: a day goes to as many tasks as slices.

    Repeats of a bar meet in its slice of the day, so telling the first ones takes no shuffle of its
    own; the day leads the sort, so the write needs no other.
    """
    gathered = bars.withColumn("_slice", part_of(slices)).repartition(tasks, DAY, "_slice")
    window = Window.partitionBy(DAY, "_slice", F.xxhash64("ticker", "millis"), "ticker", "millis").orderBy(*PLACE)
    return gathered.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank", "_slice")


def sizes_by_day(fresh: DataFrame) -> tuple[dict[int, int], int]:
    """Rows of each day, and the most that a part of a day has; a calendar bounds the days."""
    parts = fresh.groupBy(DAY, part_of(PARTS).alias("_part")).agg(F.count(F.lit(1)).alias("n"))
    counted = parts.groupBy(DAY).agg(F.sum("n").alias("n"), F.max("n").alias("most")).collect()
    return {r[DAY]: r["n"] for r in counted}, max((r["most"] for r in counted), default=0)


def merge_bars(table: DayTable, fresh: DataFrame, rebuilt: set[int] = frozenset(), label: str = "", always: bool = False, rows: int = BARS_PER_TASK) -> set[int]:
    """Bring the days of ``fresh`` up to date and return the days that may have changed.

    ``fresh`` is a dated feed as a written table; only its days are read, and ``rebuilt`` days lose
    what they held. Bars that are merged again change nothing. If another load changes one of the
    days meanwhile, the merge starts again from that load's content. ``always`` publishes a version
    under the label even if no day changes. A task gets about so many ``rows``.
    """
    sizes, most = sizes_by_day(fresh)
    # A part of a day that outweighs a task may be one bar's repeats: these go in the tasks that read them.
    new = first_of(fresh) if most > rows else fresh
    touched = sizes.keys() | rebuilt
    if not touched and not always:
        return set()
    while True:
        ground = table.version()
        held = {d: p.rows for d, p in ground.days.items() if d in sizes and d not in rebuilt}
        tasks, slices = spread({d: n + held.get(d, 0) for d, n in sizes.items()}, table.spark.sparkContext.defaultParallelism, rows)
        staged = table.stage(first_by_day(table.read(held, version=ground).unionByName(new), tasks, slices))
        try:
            table.publish(staged, touched, label, ground)
            return set(touched)
        except Conflict:
            table.discard(staged)


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """The landing files of a folder: path, file, bytes, modified; no content is read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.{json,jsonl}").load(folder)
    return found.select("path", F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"), F.unix_micros("modificationTime").alias("modified"))


def parsed(spark: SparkSession, paths: list[str], store: Store) -> tuple[DataFrame, DataFrame]:
    """The dated bars of some files, arrays or lines, and the names of those that can't be read; both staged."""
    arrays, lines = ([p for p in paths if p.endswith(glob[1:])] for glob in (ARRAYS, LINES))
    bars, bad = [], []
    if arrays:
        texts = landing_texts(spark, arrays)
        bars.append(records(texts))
        bad.append(unreadable(texts).select("file"))
    if lines:
        staged = store.stage("lines", landing_lines(spark, lines), kept=1)
        bars.append(line_records(staged))
        bad.append(broken_files(staged))
    fresh = reduce(DataFrame.unionByName, [dated(bar_feed(b)) for b in bars])
    return store.stage("new_bars", fresh, kept=1), store.stage("new_unreadable", reduce(DataFrame.unionByName, bad), kept=1)


def publish_bars(spark: SparkSession, folder: str, lake: str, token: str) -> dict[str, int]:
    """Bring the lake's bars up to date with the landing files; returns bars held, files read and files that can't be read.

    Only files that are not in the ledger as they are now are parsed. Bars are published before the
    ledger is, so a run that fails in between parses its files again and changes nothing by it.
    """
    store, table = Store(spark, f"{lake}/ledger"), bar_table(spark, lake)
    now = store.stage("listing", listed(spark, folder), kept=1)
    ledger = store.read(LEDGER)
    same = ["file", "bytes", "modified"]
    gone = ledger.join(now, same, "left_anti")
    # A calendar bounds the days, and so the files: there is one a day.
    lost = {r["day"] for r in gone.select(F.explode("days").alias("day")).distinct().collect()}
    again = ledger.join(now.select(*same), same, "left_semi").where(F.arrays_overlap("days", F.array(*map(F.lit, sorted(lost))).cast("array<int>")))
    chosen = now.join(ledger, same, "left_anti").select("path", "file").union(now.join(again, "file", "left_semi").select("path", "file"))
    paths = sorted(r["path"] for r in chosen.select("path").collect())
    if paths:
        fresh, bad = parsed(spark, paths, store)
    else:
        fresh, bad = spark.createDataFrame([], KEPT_SCHEMA), spark.createDataFrame([], "file string")
    merge_bars(table, fresh, lost, token, always=table.exists())
    days = fresh.groupBy("file").agg(F.collect_set(DAY).alias("days"))
    read = (
        now.where(F.col("path").isin(paths))
        .join(days, "file", "left")
        .join(bad.withColumn("bad", F.lit(True)), "file", "left")
        .select(*same, F.coalesce("days", F.array().cast("array<int>")).alias("days"), F.col("bad").isNull().alias("readable"))
    )
    if paths or lost or gone.count():
        kept = store.change(LEDGER, lambda old: old.join(now, same, "left_semi").join(read, "file", "left_anti").unionByName(read))
    else:
        kept = ledger
    unread = kept.where("NOT readable")
    return {"bars": sum(p.rows for p in table.version().days.values()), "bar_files_read": len(paths), "bars_unreadable": unread.count()}


def unreadable_files(spark: SparkSession, lake: str) -> DataFrame:
    """The files that the ledger knows as unreadable: file."""
    return Store(spark, f"{lake}/ledger").read(LEDGER).where("NOT readable").select("file")


def lake_bars(spark: SparkSession, lake: str, label: str | None = None, days: list[int] | None = None) -> DataFrame:
    """The lake's bars, of a snapshot by its token or the latest; of some days, whose folders alone are listed."""
    return bar_table(spark, lake).read(days, label).select(*SCHEMAS["bars"].names)


def has_bars(spark: SparkSession, lake: str) -> bool:
    """Whether a lake keeps bars by day."""
    return files.exists(spark, f"{lake}/bars_by_day")
