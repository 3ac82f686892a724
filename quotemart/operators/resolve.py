"""Key resolution with a disposition per row; bad rows are told apart instead of failing the batch."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemart.functions.calendar import market_time
from quotemart.functions.values import flag, present, whole_number
from quotemart.operators.dedup import mark_first
from quotemart.operators.lookup import lookup_side
from quotemart.schemas import LENGTHS


def too_long(table: str, names: dict[str, str]) -> Column:
    """Whether any text column exceeds its bound; ``names`` maps feed column to table column."""
    found = F.lit(False)
    for feed, column in names.items():
        found = found | F.coalesce(F.length(feed) > LENGTHS[table][column], F.lit(False))
    return found


def _disposed(df: DataFrame, checks: Sequence[tuple[Column, str, str]], otherwise: Column) -> DataFrame:
    """Add ``disposition`` and ``reason`` from the first check that holds."""
    disposition, reason = F, F
    for failed, outcome, why in checks:
        disposition = disposition.when(failed, outcome)
        reason = reason.when(failed, why)
    return df.withColumn("reason", reason).withColumn("disposition", disposition.otherwise(otherwise))


def resolve_regions(feed: DataFrame) -> DataFrame:
    """Region rows ready to load: pos, region_*, disposition, reason."""
    rows = feed.select(
        "pos",
        F.col("region").alias("region_name"),
        F.col("market_type").alias("region_market_type"),
        market_time(F.col("local_open")).alias("region_local_open"),
        market_time(F.col("local_close")).alias("region_local_close"),
    )
    bad_time = F.col("region_local_open").isNull() | F.col("region_local_close").isNull()
    bounds = {c: c for c in ("region_name", "region_market_type")}
    missing = F.col("region_name").isNull() | F.col("region_market_type").isNull()
    checks = [
        (missing, "skipped", "missing value"),
        (bad_time, "skipped", "bad time"),
        (too_long("regions", bounds), "skipped", "too long"),
    ]
    return _disposed(rows, checks, F.lit("inserted"))


def resolve_industries(feed: DataFrame) -> DataFrame:
    """Industry rows ready to load: industry_*, disposition, reason."""
    rows = feed.select(
        F.col("industry").alias("industry_name"), F.col("sector").alias("industry_sector")
    )
    bounds = {c: c for c in ("industry_name", "industry_sector")}
    missing = F.col("industry_name").isNull() | F.col("industry_sector").isNull()
    checks = [
        (missing, "skipped", "missing value"),
        (too_long("industries", bounds), "skipped", "too long"),
    ]
    return _disposed(rows, checks, F.lit("inserted"))


def resolve_sic(feed: DataFrame) -> DataFrame:
    """SIC rows ready to load; rows without a code are left out uncounted."""
    rows = feed.where(present(F.col("sic"))).select(
        "pos",
        whole_number(F.col("sic")).alias("sic_id"),
        F.col("sicIndustry").alias("sic_industry"),
        F.col("sicSector").alias("sic_sector"),
    )
    bounds = {c: c for c in ("sic_industry", "sic_sector")}
    missing = F.col("sic_industry").isNull() | F.col("sic_sector").isNull()
    checks = [
        (F.col("sic_id").isNull(), "skipped", "bad number"),
        (missing, "skipped", "missing value"),
        (too_long("sicindustries", bounds), "skipped", "too long"),
    ]
    return _disposed(rows, checks, F.lit("inserted"))


def resolve_exchanges(feed: DataFrame, regions: DataFrame, size: int | None = None) -> DataFrame:
    """Exchange rows with their region id; names match case-sensitively. ``size`` bounds the regions, if known."""
    known = regions.select(
        F.col("region_name").alias("region"), F.col("region_id").alias("exchange_region_id")
    )
    rows = feed.join(lookup_side(known, size=size), "region", "left").withColumnRenamed("name", "exchange_name")
    checks = [
        (~present(F.col("exchange_name")), "skipped", "no name"),
        (F.col("exchange_region_id").isNull(), "error", "unknown region"),
        (too_long("exchanges", {"exchange_name": "exchange_name"}), "error", "too long"),
    ]
    return _disposed(rows, checks, F.lit("inserted"))


def resolve_companies(
    feed: DataFrame,
    exchanges: DataFrame,
    industries: DataFrame,
    sics: DataFrame,
    companies: DataFrame,
    stage: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    sizes: Mapping[str, int | None] | None = None,
) -> DataFrame:
    """Company rows with exchange, industry and SIC ids and the fate of every row.

    Unknown industry or SIC codes give NULL ids; an unknown exchange rejects the row, and so does
    an empty one, because the table needs an exchange. ``known`` tells whether the key was in the
    table before the batch. Of a new key only the first acceptable row is inserted. The checked rows
    are read twice; ``stage`` may write them so that the joins run once. ``sizes`` bounds the lookup
    tables by name, where known.
    """
    known = sizes or {}
    rows = feed.select(
        "pos",
        F.col("name").alias("company_name"),
        F.col("cik").alias("company_cik"),
        F.col("ticker").alias("company_ticker"),
        flag(F.col("isDelisted")).alias("company_is_delisted"),
        F.col("category").alias("company_category"),
        F.col("currency").alias("company_currency"),
        F.col("location").alias("company_location"),
        F.col("exchange").alias("exchange_name"),
        F.col("industry").alias("industry_name"),
        F.col("sector").alias("industry_sector"),
        whole_number(F.col("sic")).alias("company_sic_id"),
    )
    exchange_ids = exchanges.select("exchange_name", F.col("exchange_id").alias("company_exchange_id"))
    industry_ids = industries.select(
        "industry_name", "industry_sector", F.col("industry_id").alias("company_industry_id")
    )
    sic_ids = sics.select(F.col("sic_id").alias("company_sic_id"), F.lit(True).alias("_sic_known"))
    held = companies.select("company_ticker", "company_is_delisted", F.lit(True).alias("known"))
    joined = (
        rows.join(lookup_side(exchange_ids, size=known.get("exchanges")), "exchange_name", "left")
        .join(lookup_side(industry_ids, size=known.get("industries")), ["industry_name", "industry_sector"], "left")
        .join(lookup_side(sic_ids, size=known.get("sicindustries")), "company_sic_id", "left")
        .join(lookup_side(held, size=known.get("companies")), ["company_ticker", "company_is_delisted"], "left")
        .withColumn("known", F.coalesce("known", F.lit(False)))
        .withColumn("company_sic_id", F.when(F.col("_sic_known"), F.col("company_sic_id")))
        .drop("_sic_known")
    )
    incomplete = ~(
        present(F.col("company_ticker")) & present(F.col("company_name")) & present(F.col("company_cik"))
    )
    no_exchange = F.col("company_exchange_id").isNull()
    bounds = {c: c for c in LENGTHS["companies"]}
    checks = [
        (incomplete, "skipped", "no ticker, name or cik"),
        (no_exchange & present(F.col("exchange_name")), "error", "unknown exchange"),
        (no_exchange, "skipped", "no exchange"),
        (too_long("companies", bounds), "error", "too long"),
    ]
    checked = stage(_disposed(joined, checks, F.lit("loaded")))
    insertable = (F.col("disposition") == "loaded") & ~F.col("known")
    marked = mark_first(checked, ["company_ticker", "company_is_delisted"], "pos", "_first", insertable)
    loaded = F.col("disposition") == "loaded"
    repeated = loaded & ~F.col("known") & ~F.col("_first")
    return (
        marked.withColumn("reason", F.when(repeated, "repeated in batch").otherwise(F.col("reason")))
        .withColumn(
            "disposition",
            F.when(~loaded, F.col("disposition"))
            .when(F.col("known"), "updated")
            .when(F.col("_first"), "inserted")
            .otherwise("skipped"),
        )
        .drop("_first")
    )


def accepted(resolved: DataFrame) -> DataFrame:
    """The rows that may be loaded."""
    return resolved.where(F.col("disposition").isin("inserted", "updated")).drop("disposition", "reason")


def disposition_counts(entity: str, resolved: DataFrame) -> DataFrame:
    """Rows per disposition of one entity."""
    return (
        resolved.groupBy("disposition")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(entity).alias("entity"), "disposition", "rows")
    )
