"""Dimension rows from the source tables; keys and ``is_current`` come with the load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemart.functions.calendar import calendar_columns, day_key, time_of_day
from quotemart.functions.text import clock_text, normal_name, normal_ticker
from quotemart.functions.values import flag
from quotemart.operators.dedup import keep_first


def days(bars: DataFrame) -> DataFrame:
    """The days with bars and the bars of each; a calendar bounds its rows."""
    dated = bars.select(F.to_date("timestamp").alias("full_date")).where("full_date IS NOT NULL")
    counted = dated.groupBy("full_date").agg(F.count(F.lit(1)).alias("bars"))
    return counted.select(day_key(F.col("full_date")).alias("date_key"), "full_date", "bars")


def date_rows(bars: DataFrame) -> DataFrame:
    """One row per day with bars."""
    return calendar(days(bars))


def calendar(some_days: DataFrame) -> DataFrame:
    """Date dimension rows of ``days``."""
    day = F.col("full_date")
    return some_days.select(
        "date_key",
        day.cast("timestamp_ntz").alias("full_date"),
        *[value.alias(name) for name, value in calendar_columns(day).items()],
    )


def company_rows(companies: DataFrame) -> DataFrame:
    """One row per normalised ticker: the listed company first, then the smallest id."""
    rows = companies.dropna(subset=["company_ticker"]).select(
        "company_id",
        normal_ticker(F.col("company_ticker")).alias("_ticker"),
        "company_ticker",
        "company_name",
        "company_category",
        "company_cik",
        F.col("company_is_delisted").cast("boolean").alias("company_is_delisted"),
        "company_location",
    )
    order = [flag(F.col("company_is_delisted")), F.col("company_id")]
    return keep_first(rows, ["_ticker"], order).drop("_ticker", "company_id")


def exchange_rows(exchanges: DataFrame, regions: DataFrame) -> DataFrame:
    """One row per trimmed exchange name with its region; unknown regions leave NULLs.

    Opening times come as nanoseconds of the day or as HH:MM:SS texts.
    """
    times = ["region_local_open", "region_local_close"]
    numeric = {f.name for f in regions.schema.fields if f.dataType.typeName() != "string"}
    rows = exchanges.dropna(subset=["exchange_name"]).join(
        regions, exchanges["exchange_region_id"] == regions["region_id"], "left"
    )
    clocks = {
        c: time_of_day(F.col(c)) if c in numeric else F.coalesce(clock_text(F.col(c)), F.lit("00:00:00"))
        for c in times
    }
    named = rows.select(
        "exchange_id",
        normal_name(F.col("exchange_name")).alias("_name"),
        "exchange_name",
        "region_name",
        "region_market_type",
        *[clocks[c].alias(c) for c in times],
    )
    return keep_first(named, ["_name"], [F.col("exchange_id")]).drop("_name", "exchange_id")


def industry_rows(companies: DataFrame, industries: DataFrame, sics: DataFrame) -> DataFrame:
    """One row per sector and industry in use, with the smallest SIC code of its companies.

    Companies shrink to their distinct id pairs before any join, however many share an industry.
    """
    pairs = companies.select("company_industry_id", "company_sic_id").distinct()
    rows = (
        pairs.join(industries, pairs["company_industry_id"] == industries["industry_id"], "left")
        .join(sics, pairs["company_sic_id"] == sics["sic_id"], "left")
        .dropna("any", subset=["industry_sector", "industry_name"])
    )
    named = rows.select(
        normal_name(F.col("industry_sector")).alias("_sector"),
        normal_name(F.col("industry_name")).alias("_industry"),
        "industry_id",
        "sic_id",
        "industry_sector",
        "industry_name",
        "sic_industry",
        "sic_sector",
    )
    order = [F.col("sic_id").asc_nulls_last(), F.col("industry_id")]
    return keep_first(named, ["_sector", "_industry"], order).drop(
        "_sector", "_industry", "industry_id", "sic_id"
    )
