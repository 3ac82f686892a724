"""Feeds to normalised entities; the first row of a key wins, in feed order (``pos``)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotemart.functions.text import industry_text, split_names, text_id
from quotemart.functions.values import present
from quotemart.operators.dedup import first_rows, keep_first
from quotemart.sources.landing import COMPANY_FIELDS


def companies(feed: DataFrame) -> DataFrame:
    """The company projection."""
    return feed.select(*COMPANY_FIELDS)


def sic_industries(feed: DataFrame) -> DataFrame:
    """One row per SIC code: pos, id, sic, sicSector, sicIndustry."""
    rows = feed.where(present(F.col("sic"))).select(
        "pos",
        text_id(F.col("sic")).alias("id"),
        "sic",
        "sicSector",
        "sicIndustry",
    )
    return keep_first(rows, ["sic"], [F.col("pos")])


def industries(feed: DataFrame) -> DataFrame:
    """One row per sector and industry: pos, id, sector, industry.

    The sector is the feed's ``listed_sector`` if it has one, which is empty where the key is absent.
    """
    sector = F.col("listed_sector" if "listed_sector" in feed.columns else "sector")
    key = industry_text(sector, F.col("industry"))
    rows = feed.where(present(F.col("industry"))).select(
        "pos",
        text_id(key).alias("id"),
        sector.alias("sector"),
        "industry",
        key.alias("_key"),
    )
    return keep_first(rows, ["_key"], [F.col("pos")]).drop("_key")


def regions(markets: DataFrame) -> DataFrame:
    """One row per region: pos, id, region, market_type, local_open, local_close."""
    rows = markets.where(present(F.col("region"))).select(
        "pos",
        text_id(F.col("region")).alias("id"),
        "region",
        "market_type",
        "local_open",
        "local_close",
    )
    return keep_first(rows, ["region"], [F.col("pos")])


def exchanges(markets: DataFrame) -> DataFrame:
    """One row per exchange of the markets' lists, with the columns of the market that named it first."""
    named = markets.select(
        "pos",
        F.posexplode(split_names(F.col("primary_exchanges"))).alias("_place", "name"),
        "region",
        "market_type",
        "local_open",
        "local_close",
    )
    first = keep_first(named, ["name"], [F.col("pos"), F.col("_place")])
    return first.select(
        "pos", text_id(F.col("name")).alias("id"), "name", "region", "market_type", "local_open", "local_close"
    )


def join_lists(lists: Sequence[DataFrame], total: int | None) -> DataFrame:
    """Company lists of several crawls as one feed, in list order; each list gives its share of ``total``.

    A list starts where the positions of the one before end; without a limit all rows come.
    """
    tagged = [rows.withColumn("_list", F.lit(i)) for i, rows in enumerate(lists)]
    joined = reduce(DataFrame.unionByName, tagged)
    share = total // len(lists) if total and total > 0 else 0
    kept = first_rows(joined, ["_list"], [F.col("pos")], share) if share else joined
    # One row per list.
    ends = kept.groupBy("_list").agg((F.max("pos").cast("long") + 1).alias("_rows"))
    ahead = Window.orderBy("_list").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select("_list", F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_start"))
    placed = kept.join(F.broadcast(starts), "_list").withColumn("pos", F.col("_start") + F.col("pos"))
    return placed.select(*[c for c in joined.columns if c != "_list"])


def limit_per_exchange(feed: DataFrame, total: int | None, exchanges: int) -> DataFrame:
    """The first companies of each exchange in feed order, ``total`` shared evenly; no limit if not positive."""
    if not total or total <= 0:
        return feed
    share = total // exchanges
    return first_rows(feed, ["exchange"], [F.col("pos")], share) if share else feed
