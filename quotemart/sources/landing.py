"""JSON landing files: arrays of objects, one file per crawl.

A file is parsed as a whole because a JSON array cannot be split and a broken file must be dropped
whole; files are the unit of parallel work. The shared reader keeps (file, position), which the
first-wins rules need, and tells an absent key from a null one.

Bars may also land as JSON lines, one object a line. Such a file is split: every split numbers its
lines, and the lines of the splits before it are added, so that lines get the places that the
elements of an array would have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quotemart.functions.calendar import millis_to_timestamp
from quotemart.functions.values import flag
from quotemart.operators.lookup import lookup_side
from quotemart.schemas import SCHEMAS

RECORDS_TYPE = "array<map<string,string>>"
RECORD_TYPE = "map<string,string>"
ARRAYS, LINES = "*.json", "*.jsonl"

# The keys read from each feed.
COMPANY_FIELDS = [
    "id",
    "name",
    "ticker",
    "cik",
    "cusip",
    "exchange",
    "isDelisted",
    "category",
    "sector",
    "industry",
    "sic",
    "currency",
    "location",
]
SIC_FIELDS = ["sicSector", "sicIndustry"]
MARKET_FIELDS = ["region", "market_type", "local_open", "local_close", "primary_exchanges"]
BAR_KEYS = {
    "ticker": "T",
    "open": "o",
    "high": "h",
    "low": "l",
    "close": "c",
    "volume": "v",
    "vwap": "vw",
    "timestamp": "t",
    "transactions": "n",
}


def latest_file(spark: SparkSession, folder: str, suffix: str = ".json") -> str | None:
    """Path of the most recently modified file of a folder; hidden files do not count."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder)
    newest = files.select("path", "modificationTime").agg(
        F.max_by("path", F.struct("modificationTime", "path")).alias("path")
    )
    return newest.first()["path"]


def landing_texts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per landing file of a folder, or of a list of files: file, value."""
    reader = spark.read.format("text").option("wholetext", True).option("pathGlobFilter", ARRAYS)
    texts = reader.load(path)
    return texts.select(F.col("_metadata.file_name").alias("file"), "value")


def records(texts: DataFrame, value: str = "value") -> DataFrame:
    """The objects of the JSON arrays in ``value``: all other columns, pos, record.

    A text that is not a well-formed array of objects gives no rows.
    """
    rest = [c for c in texts.columns if c != value]
    return texts.select(*rest, F.posexplode(F.from_json(value, RECORDS_TYPE)).alias("pos", "record"))


def unreadable(texts: DataFrame, value: str = "value") -> DataFrame:
    """The texts that are no well-formed array of objects, without their content."""
    return texts.where(F.from_json(value, RECORDS_TYPE).isNull()).drop(value)


def landing_lines(spark: SparkSession, path: str | list[str], glob: str = LINES) -> DataFrame:
    """One row per line of the landing files: file, split, line, value.

    ``line`` rises along a split, by one a line. Splits are read whole and in order, so the rows
    should be staged before they are numbered in files.
    """
    lines = spark.read.format("text").option("pathGlobFilter", glob).load(path)
    return lines.select(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )


def placed_lines(lines: DataFrame) -> DataFrame:
    """Staged lines with their place in their file: file, pos, value."""
    # One row for each split.
    splits = lines.groupBy("file", "split").agg(F.min("line").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("file", "split", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return lines.join(lookup_side(starts), ["file", "split"]).select("file", (F.col("line") + F.col("shift")).cast("int").alias("pos"), "value")


def broken_files(lines: DataFrame) -> DataFrame:
    """The files with a line that is neither blank nor an object: file."""
    bad = (F.trim("value") != "") & F.from_json("value", RECORD_TYPE).isNull()
    return lines.where(bad).select("file").distinct()


def line_records(lines: DataFrame) -> DataFrame:
    """The objects of staged lines: file, pos, record; a file with a broken line gives no rows."""
    whole = placed_lines(lines).join(lookup_side(broken_files(lines)), "file", "left_anti")
    return whole.where(F.trim("value") != "").select("file", "pos", F.from_json("value", RECORD_TYPE).alias("record"))


def field(name: str) -> Column:
    """Value of a key, NULL if it is null or absent."""
    return F.try_element_at("record", F.lit(name))


def has(name: str) -> Column:
    """Whether the record holds a key, be it with a null value."""
    return F.map_contains_key("record", name)


def market_texts(envelopes: DataFrame, value: str = "value") -> DataFrame:
    """Unwrap ``{"markets": [...]}``: ``value`` becomes the array text, NULL without that key."""
    return envelopes.withColumn(value, F.get_json_object(value, "$.markets"))


def company_feed(rows: DataFrame) -> DataFrame:
    """Company records projected to the feed columns; absent keys give NULL.

    Industries and SIC codes take an empty text for an absent sector or name, while a null one stays
    null: that is what ``listed_sector``, ``sicSector`` and ``sicIndustry`` hold.
    """
    keep = [c for c in rows.columns if c != "record"]
    texts = {c: F.when(has(c), field(c)).otherwise("") for c in SIC_FIELDS}
    texts["listed_sector"] = F.when(has("sector"), field("sector")).otherwise("")
    feed = rows.select(*keep, *[field(c).alias(c) for c in COMPANY_FIELDS], *[v.alias(c) for c, v in texts.items()])
    return feed.withColumn("isDelisted", F.when(F.col("isDelisted").isNotNull(), flag(F.col("isDelisted"))))


def market_feed(rows: DataFrame) -> DataFrame:
    """Market records projected to the feed columns; absent keys give an empty text."""
    keep = [c for c in rows.columns if c != "record"]
    values = [F.when(has(c), field(c)).otherwise("").alias(c) for c in MARKET_FIELDS]
    return rows.select(*keep, *values)


def bar_feed(rows: DataFrame) -> DataFrame:
    """Bar records under long or short keys, typed; the short key counts only if the long is absent.

    The raw milliseconds stay as ``millis``: repeated bars are told by them.
    """
    keep = [c for c in rows.columns if c != "record"]
    texts = {
        long: F.coalesce(field(long), F.when(~has(long), field(short))) for long, short in BAR_KEYS.items()
    }
    types = {f.name: f.dataType for f in SCHEMAS["bars"].fields}
    millis = texts.pop("timestamp").try_cast("bigint")
    values = {c: text.try_cast(types[c]) for c, text in texts.items()}
    values["otc"] = F.when(has("otc"), field("otc").try_cast("boolean")).otherwise(False)
    values["timestamp"] = millis_to_timestamp(millis)
    return rows.select(*keep, *[values[c].alias(c) for c in types], millis.alias("millis"))


def company_texts(spark: SparkSession, folder: str) -> DataFrame | None:
    """The newest company landing file, None if the folder has none."""
    path = latest_file(spark, folder)
    return landing_texts(spark, path) if path else None


def bare_market_texts(spark: SparkSession, folder: str) -> DataFrame | None:
    """The newest market landing file without its envelope, None if the folder has none."""
    path = latest_file(spark, folder)
    if not path:
        return None
    bare = F.coalesce(F.get_json_object("value", "$.markets"), F.col("value"))
    return landing_texts(spark, path).withColumn("value", bare)


def read_companies(spark: SparkSession, folder: str) -> DataFrame | None:
    """The newest company landing file as a feed with positions, None if the folder has none."""
    texts = company_texts(spark, folder)
    return None if texts is None else company_feed(records(texts)).drop("file")


def read_markets(spark: SparkSession, folder: str) -> DataFrame | None:
    """The newest market landing file as a feed with positions, None if the folder has none.

    Takes the bare array as well as the enveloped form.
    """
    texts = bare_market_texts(spark, folder)
    return None if texts is None else market_feed(records(texts)).drop("file")


def read_bars(spark: SparkSession, folder: str) -> DataFrame:
    """All bar landing files of a folder as one feed with file and position."""
    return bar_feed(records(landing_texts(spark, folder)))
