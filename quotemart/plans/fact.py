"""The daily price fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemart.functions.calendar import day_key
from quotemart.functions.text import normal_name, normal_ticker
from quotemart.functions.values import flag, money, price_trend, share_volume
from quotemart.operators.dedup import keep_first
from quotemart.operators.history import current
from quotemart.operators.lookup import lookup_side
from quotemart.operators.skew import spread_join


# A row of keys holds a ticker of at most 10 characters and three integers: some 100 MB at this bound.
KEY_ROWS = 1_000_000


def first_bars(feed: DataFrame) -> DataFrame:
    """The first bar of every ticker and raw millisecond in file order, oldest file name first."""
    kept = keep_first(feed, ["ticker", "millis"], [F.col("file"), F.col("pos")])
    return kept.drop("file", "pos", "millis")


def ticker_keys(
    companies: DataFrame,
    exchanges: DataFrame,
    industries: DataFrame,
    dim_company: DataFrame,
    dim_exchange: DataFrame,
    dim_industry: DataFrame,
    every_listing: bool = False,
    industry_by_name: bool = False,
) -> DataFrame:
    """Warehouse keys per normalised ticker, from the current dimension rows.

    All lookups meet here, among tables the size of the company list, so the bars need one join
    instead of six. A ticker listed and delisted counts once, listed first, unless
    ``every_listing``; industries match on sector and name unless ``industry_by_name``.
    """
    listed = companies.select(
        normal_ticker(F.col("company_ticker")).alias("ticker"),
        F.col("company_exchange_id").alias("exchange_id"),
        F.col("company_industry_id").alias("industry_id"),
        flag(F.col("company_is_delisted")).alias("_delisted"),
        "company_id",
    ).where("ticker IS NOT NULL")
    if not every_listing:
        listed = keep_first(listed, ["ticker"], [F.col("_delisted"), F.col("company_id")])
    company_keys = current(dim_company).select(
        "company_key", normal_ticker(F.col("company_ticker")).alias("ticker")
    )
    exchange_keys = exchanges.select("exchange_id", normal_name(F.col("exchange_name")).alias("_name")).join(
        current(dim_exchange).select("exchange_key", normal_name(F.col("exchange_name")).alias("_name")),
        "_name",
    )
    match = ["_industry"] if industry_by_name else ["_industry", "_sector"]
    names = [
        normal_name(F.col("industry_name")).alias("_industry"),
        normal_name(F.col("industry_sector")).alias("_sector"),
    ]
    industry_keys = (
        industries.select("industry_id", *names)
        .select("industry_id", *match)
        .join(current(dim_industry).select("industry_key", *names).select("industry_key", *match), match)
    )
    return (
        listed.join(company_keys, "ticker")
        .join(exchange_keys.select("exchange_id", "exchange_key"), "exchange_id")
        .join(industry_keys.select("industry_id", "industry_key"), "industry_id")
        .select("ticker", "company_key", "industry_key", "exchange_key")
    )


def daily_fact(
    bars: DataFrame,
    keys: DataFrame,
    keys_bound: DataFrame | None = None,
    spread: tuple[int, int] | None = None,
    keys_size: int | None = None,
    total: int | None = None,
) -> DataFrame:
    """One row per distinct bar of a ticker that resolves in every dimension.

    ``spread`` (tasks, slices) gathers the rows for a write by day: a day goes to as many tasks as
    slices, told by its company. Repeated rows meet there as well, so they need no shuffle of their own.

    ``keys_bound`` is a cheap table with at least as many rows as ``keys``, ``keys_size`` their number
    if it is known; they decide whether the keys are broadcast. If they are not, and the number of bars is given
    as ``total``, heavy tickers are joined in pieces. The trend comes from the unrounded change, and repeated rows go before
    rounding.
    """
    day = F.to_date("timestamp")
    change = F.col("close") - F.col("open")
    priced = bars.select(
        normal_ticker(F.col("ticker")).alias("ticker"),
        day_key(day).alias("date_key"),
        "open",
        "high",
        "low",
        "close",
        share_volume(F.col("volume")).alias("volume"),
        change.alias("price_change"),
    )
    side = lookup_side(keys, keys_bound, KEY_ROWS, keys_size)
    joined = spread_join(priced, keys, "ticker", total) if side is keys and total else priced.join(side, "ticker")
    resolved = joined.drop("ticker").dropna("any", subset=["company_key", "industry_key", "exchange_key"])
    if spread:
        tasks, slices = spread
        sliced = resolved.withColumn("_slice", F.pmod(F.hash("company_key"), F.lit(slices)))
        resolved = sliced.repartition(tasks, "date_key", "_slice").distinct().drop("_slice")
    else:
        resolved = resolved.distinct()
    return resolved.select(
        "date_key",
        "company_key",
        "industry_key",
        "exchange_key",
        money(F.col("open")).alias("open_price"),
        money(F.col("high")).alias("high_price"),
        money(F.col("low")).alias("low_price"),
        money(F.col("close")).alias("close_price"),
        "volume",
        money(F.col("price_change")).alias("price_change"),
        price_trend(F.col("price_change")).alias("price_trend"),
    )
