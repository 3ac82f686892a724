"""Incremental daily load: only new landing files are parsed and only their days are rebuilt.

The state between batches is the lake's bars by day: the first bar of every ticker and time, with its
place in the landing files. A batch reads the days it touches, as many rows as there are tickers, and
replaces them, so neither rows nor files of a day grow with the batches.

The result equals that of the full load as long as company, exchange and industry rows stay as they
are; a day is resolved against them when it is rebuilt.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quotemart.plans.jobs import load_fact, report_unreadable
from quotemart.plans.lake import bar_table, dated, lake_bars, merge_bars
from quotemart.sinks.store import Store
from quotemart.sources.landing import bar_feed, records


def stream_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Bar landing files as a stream of texts: file, value."""
    texts = (
        spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", "*.json").load(folder)
    )
    return texts.select(F.col("_metadata.file_name").alias("file"), "value")


def load_batch(texts: DataFrame, lake: str, batch: int, lake_tables: Mapping[str, DataFrame], store: Store) -> None:
    """Merge one batch of bars into the lake and rebuild the fact of the days it touches.

    The names of files that can't be read are staged for audit. A batch that runs again changes
    nothing, and rebuilds its days again.
    """
    spark = texts.sparkSession
    report_unreadable(texts, "bars", store)
    # The batch is parsed once: its days and the merge read the staged rows.
    fresh = store.stage("batch_bars", dated(bar_feed(records(texts))), kept=1)
    days = merge_bars(bar_table(spark, lake), fresh, label=f"batch {batch}")
    if days:
        load_fact(lake_bars(spark, lake, days=sorted(days)), lake_tables, store)


def follow_bars(
    spark: SparkSession,
    landing: str,
    lake: str,
    checkpoint: str,
    lake_tables: Mapping[str, DataFrame],
    store: Store,
) -> StreamingQuery:
    """Load all landing files not seen before, then stop."""
    return (
        stream_texts(spark, landing)
        .writeStream.foreachBatch(lambda texts, batch: load_batch(texts, lake, batch, lake_tables, store))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
