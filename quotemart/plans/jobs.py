"""The two jobs: the source tables from landing files, and the warehouse from lake snapshots."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemart.operators import quality
from quotemart.operators.dedup import keep_first
from quotemart.operators.history import (
    append_current,
    company_key,
    exchange_key,
    expire_and_insert,
    industry_key,
)
from quotemart.operators.resolve import (
    accepted,
    disposition_counts,
    resolve_companies,
    resolve_exchanges,
    resolve_industries,
    resolve_regions,
    resolve_sic,
)
from quotemart.operators.upsert import insert_absent, merge_companies, shaped, upsert, upsert_sic
from quotemart.plans import dimensions, normalize
from quotemart.plans.fact import daily_fact, ticker_keys
from quotemart.plans.lake import has_bars, lake_bars, publish_bars, unreadable_files
from quotemart.schemas import (
    DIMENSIONS,
    FACT,
    FOREIGN,
    REQUIRED,
    SCHEMAS,
    SOURCE_TABLES,
    STAMPS,
    UNIQUE,
)
from quotemart.sinks.fact import init_fact, sizes_of, spread, write_days
from quotemart.sinks.snapshots import keep_latest, write_json, write_snapshot
from quotemart.sinks.store import Store, fact_path
from quotemart.sources import files
from quotemart.sources.landing import bare_market_texts, company_texts, read_companies, read_markets, unreadable
from quotemart.sources.snapshots import read_snapshot

SNAPSHOT = "snapshot_date"


def references_of(tables: Mapping[str, DataFrame], name: str) -> dict[str, tuple[DataFrame, str]]:
    """Key columns of a table with the tables they refer to."""
    return {
        column: (tables[parent], parent_column)
        for (child, column), (parent, parent_column) in FOREIGN.items()
        if child == name
    }


def constraints(tables: Mapping[str, DataFrame], names: list[str]) -> list[DataFrame]:
    """All constraint checks of the named tables; ``tables`` must hold their parents too."""
    checks = []
    for name in names:
        checks.append(quality.not_null(tables[name], name, REQUIRED[name]))
        checks += [quality.unique(tables[name], name, key) for key in UNIQUE.get(name, [])]
        references = references_of(tables, name)
        if references:
            checks.append(quality.foreign_keys(tables[name], name, references))
    return checks


def require_or_revert(store: Store, written: list[str], checks: list[DataFrame]) -> None:
    """Raise if a constraint is broken, after the tables just written are back at the version before."""
    try:
        quality.require(checks)
    except quality.ConstraintError:
        for table in written:
            store.revert(table)
        raise


UNREADABLE = "unreadable"


def report_unreadable(texts: DataFrame, feed: str, store: Store) -> DataFrame:
    """Stage the names of landing files that are no well-formed array of objects, and return them: feed, file."""
    return store.stage(UNREADABLE, unreadable(texts).select(F.lit(feed).alias("feed"), "file"))


def load_source(
    spark: SparkSession, landing: str, store: Store, processed: str | None = None, token: str = ""
) -> DataFrame:
    """Bring the source tables up to date from the newest landing files; returns disposition counts.

    A newest file that can't be read gives no rows; it is named in the audit and counted as
    ``unreadable`` under its feed's folder.
    """
    feed, markets = read_companies(spark, f"{landing}/companies"), read_markets(spark, f"{landing}/markets")
    counts = load_feeds(spark, feed, markets, store, processed, token)
    bad = []
    for name, texts in (("companies", company_texts(spark, f"{landing}/companies")), ("markets", bare_market_texts(spark, f"{landing}/markets"))):
        if texts is not None:
            found = report_unreadable(texts, name, store)
            bad.append(found.groupBy(F.col("feed").alias("entity")).agg(F.count("*").alias("rows")).select("entity", F.lit(UNREADABLE).alias("disposition"), "rows"))
    return quality.report([counts, *bad])


def load_feeds(
    spark: SparkSession,
    feed: DataFrame | None,
    markets: DataFrame | None,
    store: Store,
    processed: str | None = None,
    token: str = "",
) -> DataFrame:
    """Bring the source tables up to date from a company and a market feed; returns disposition counts.

    Order matters: exchanges need region ids, companies need all other ids. Every entity's rows are
    staged with their dispositions, rejects included, before the table changes. Entities are
    written as JSON too if ``processed`` names a folder.
    """
    now = F.localtimestamp()
    entities: dict[str, DataFrame] = {}
    # A feed is parsed once; every entity reads the staged rows.
    markets = None if markets is None else store.stage("market_feed", markets, kept=1)
    feed = None if feed is None else store.stage("company_feed", feed, kept=1)
    if markets is not None:
        entities["regions"] = normalize.regions(markets)
        entities["exchanges"] = normalize.exchanges(markets)
    if feed is not None:
        entities["industries"] = normalize.industries(feed)
        entities["sicindustries"] = normalize.sic_industries(feed)
        entities["companies"] = normalize.companies(feed)
    if processed:
        for name, rows in entities.items():
            write_json(rows, f"{processed}/{name}", SNAPSHOT, token)
            keep_latest(spark, f"{processed}/{name}", SNAPSHOT)

    staged: dict[str, DataFrame] = {}
    if markets is not None:
        staged["regions"] = store.stage("regions", resolve_regions(entities["regions"]))
        columns = ["region_market_type", "region_local_open", "region_local_close"]
        store.change(
            "regions",
            lambda old: upsert(old, accepted(staged["regions"]), ["region_name"], columns, "region_id", STAMPS["regions"], now),
        )
    if feed is not None:
        staged["industries"] = store.stage("industries", resolve_industries(entities["industries"]))
        pair = ["industry_name", "industry_sector"]
        store.change(
            "industries",
            lambda old: insert_absent(old, accepted(staged["industries"]), pair, "industry_id", STAMPS["industries"], now),
        )
        staged["sicindustries"] = store.stage("sicindustries", resolve_sic(entities["sicindustries"]))
        # Codes that differ as text but not as numbers: the later text updates the earlier row.
        codes = keep_first(accepted(staged["sicindustries"]), ["sic_id"], [F.col("pos").desc()])
        store.change("sicindustries", lambda old: upsert_sic(old, codes, STAMPS["sicindustries"], now))
    if markets is not None:
        rows = resolve_exchanges(entities["exchanges"], store.read("regions"), store.rows("regions"))
        staged["exchanges"] = store.stage("exchanges", rows)
        region = ["exchange_region_id"]
        store.change(
            "exchanges",
            lambda old: upsert(old, accepted(staged["exchanges"]), ["exchange_name"], region, "exchange_id", STAMPS["exchanges"], now),
        )
    if feed is not None:

        def merged(old: DataFrame) -> DataFrame:
            """Which keys are known depends on the version that is changed, so rows are resolved for each attempt."""
            names = ["exchanges", "industries", "sicindustries"]
            sizes = {t: store.rows(t) for t in [*names, "companies"]}
            once = lambda rows: store.stage("companies_checked", rows, kept=1)
            rows = resolve_companies(feed, *[store.read(t) for t in names], old, once, sizes)
            staged["companies"] = store.stage("companies", rows)
            return merge_companies(old, staged["companies"], STAMPS["companies"], now)

        store.change("companies", merged)
    require_or_revert(store, list(staged), constraints({t: store.read(t) for t in SOURCE_TABLES}, SOURCE_TABLES))
    empty = spark.createDataFrame([], "entity string, disposition string, rows bigint")
    return quality.report([empty, *[disposition_counts(name, rows) for name, rows in staged.items()]])


def snapshot_tables(
    tables: Mapping[str, DataFrame], bars: DataFrame | None, lake: str, token: str
) -> dict[str, int]:
    """Publish table snapshots, and a whole set of bars as one, to the lake; empty ones left out, older ones go."""
    rows = {}
    for name, df in tables.items():
        rows[name] = write_snapshot(shaped(df, SCHEMAS[name]), f"{lake}/db/{name}", SNAPSHOT, token)
        keep_latest(df.sparkSession, f"{lake}/db/{name}", SNAPSHOT)
    if bars is not None:
        rows["bars"] = write_snapshot(shaped(bars, SCHEMAS["bars"]), f"{lake}/bars", SNAPSHOT, token)
        keep_latest(bars.sparkSession, f"{lake}/bars", SNAPSHOT)
    return rows


def publish(spark: SparkSession, landing: str, source: Store, lake: str, token: str) -> dict[str, int]:
    """Snapshot the source tables and bring the lake's bars up to date from new files.

    Returns rows by table, how many bar files were read, and how many can't be read; the names of
    the latter are staged for audit in every run.
    """
    done = snapshot_tables({t: source.read(t) for t in SOURCE_TABLES}, None, lake, token)
    if not files.names(spark, f"{landing}/bars"):
        return done
    done |= publish_bars(spark, f"{landing}/bars", lake, token)
    source.stage(UNREADABLE, unreadable_files(spark, lake).select(F.lit("bars").alias("feed"), "file"))
    return done


def load_dimensions(lake_tables: Mapping[str, DataFrame], store: Store, append: bool = False) -> None:
    """Bring the company, exchange and industry dimension up to date."""
    companies, exchanges = lake_tables["companies"], lake_tables["exchanges"]
    plans = {
        "dim_company": (dimensions.company_rows(companies), company_key, "company_key"),
        "dim_exchange": (
            dimensions.exchange_rows(exchanges, lake_tables["regions"]),
            exchange_key,
            "exchange_key",
        ),
        "dim_industry": (
            dimensions.industry_rows(companies, lake_tables["industries"], lake_tables["sicindustries"]),
            industry_key,
            "industry_key",
        ),
    }
    change = append_current if append else expire_and_insert
    for table, (rows, natural, key) in plans.items():
        # Read three times by the change: against the current rows, for new ones and for their keys.
        rows = store.stage(f"{table}_rows", rows, kept=1)
        store.change(table, lambda old, rows=rows, natural=natural, key=key: change(old, rows, natural, key))


def load_fact(
    bars: DataFrame,
    lake_tables: Mapping[str, DataFrame],
    store: Store,
    every_listing: bool = False,
    industry_by_name: bool = False,
) -> dict[str, int]:
    """Add the bars' days to the date dimension and replace those days in the fact, once it is checked."""
    # One row per day of the calendar; used by the date dimension and the replaced days.
    touched = store.stage("days", dimensions.days(bars), kept=1)
    sizes = sizes_of(touched)
    store.change("dim_date", lambda old: insert_absent(old, dimensions.calendar(touched), ["date_key"]))
    keys = ticker_keys(
        lake_tables["companies"],
        lake_tables["exchanges"],
        lake_tables["industries"],
        store.read("dim_company"),
        store.read("dim_exchange"),
        store.read("dim_industry"),
        every_listing,
        industry_by_name,
    )
    keys = store.stage("ticker_keys", keys)
    path = fact_path(store)
    cores = store.spark.sparkContext.defaultParallelism
    known = store.rows("audit/ticker_keys")
    fact = daily_fact(bars, keys, spread=spread(sizes, cores), keys_size=known, total=sum(sizes.values()))
    return write_days(fact, path, sizes, references_of({t: store.read(t) for t in DIMENSIONS}, FACT))


def init_warehouse(store: Store) -> None:
    """Make all warehouse tables empty."""
    store.init(DIMENSIONS)
    init_fact(store.spark, fact_path(store))


def load_warehouse(
    spark: SparkSession,
    lake: str,
    store: Store,
    snapshot: str | None = None,
    trading_date: int | None = None,
    append: bool = False,
    every_listing: bool = False,
    industry_by_name: bool = False,
) -> dict[str, int]:
    """Load dimensions and fact from the lake.

    ``snapshot`` names a bar snapshot by its token, by default the latest; ``trading_date`` limits
    the load to one day key. The flags choose the literal behaviours told in ``load_dimensions`` and
    ``ticker_keys``.
    """
    tables = {t: read_snapshot(spark, f"{lake}/db/{t}", SNAPSHOT, SCHEMAS[t]) for t in SOURCE_TABLES}
    if has_bars(spark, lake):
        bars = lake_bars(spark, lake, snapshot, None if trading_date is None else [trading_date])
    else:
        bars = read_snapshot(spark, f"{lake}/bars", SNAPSHOT, SCHEMAS["bars"], snapshot)
    if trading_date is not None:
        day = F.to_timestamp_ntz(F.lit(str(trading_date)), F.lit("yyyyMMdd"))
        bars = bars.where((F.col("timestamp") >= day) & (F.col("timestamp") < day + F.expr("INTERVAL '1' DAY")))
    load_dimensions(tables, store, append)
    changed = [t for t in DIMENSIONS if t != "dim_date"]
    require_or_revert(store, changed, constraints({t: store.read(t) for t in changed}, changed))
    done = load_fact(bars, tables, store, every_listing, industry_by_name)
    quality.require(constraints({"dim_date": store.read("dim_date")}, ["dim_date"]))
    return done
