"""One check query per operator of the inventory; each reads the given tables whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemart.checks.bindings import Given
from quotemart.functions.calendar import landing_day, time_of_day, trading_day
from quotemart.functions.text import clock_text, date_token, token_date, token_of
from quotemart.functions.values import money, price_trend
from quotemart.operators import quality
from quotemart.operators.days import drop_null_keys, replace_days
from quotemart.operators.history import (
    append_current,
    company_key,
    exchange_key,
    expire_and_insert,
    industry_key,
)
from quotemart.operators.keys import assign_keys
from quotemart.operators.resolve import (
    disposition_counts,
    resolve_companies,
    resolve_exchanges,
    resolve_industries,
    resolve_regions,
    resolve_sic,
)
from quotemart.operators.upsert import insert_absent, merge_companies, upsert, upsert_sic
from quotemart.plans import dimensions, normalize
from quotemart.plans.fact import daily_fact, first_bars, ticker_keys
from quotemart.plans.jobs import load_feeds, load_warehouse, references_of, snapshot_tables
from quotemart.plans.lake import KEPT_SCHEMA, bar_table, dated, merge_bars
from quotemart.schemas import DIMENSIONS, FACT, FOREIGN, LENGTHS, REQUIRED, SCHEMAS, UNIQUE
from quotemart.session import scratch_dir
from quotemart.sinks.fact import read_fact, sizes_of, spread, write_days
from quotemart.sinks.snapshots import keep_latest, write_json, write_snapshot, write_snapshots
from quotemart.sinks.store import Store, fact_path
from quotemart.sources import landing
from quotemart.sources.snapshots import only_latest, read_all_snapshots, read_snapshot

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
# Landed files, and rows of each in larger feeds: some 65 MB shuffled to the task that writes it.
LANDED_FILES, LANDED_ROWS = 4, 1_000_000


def query(build: Callable[[Given], DataFrame]) -> Callable[[Given], DataFrame]:
    """Register a query under its function name."""
    QUERIES[build.__name__] = lambda spark, folder: build(Given(spark, folder))
    return build


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so both engines hand over the same type."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def as_time(day: Column) -> Column:
    """A date at midnight, so both engines hand over the same type."""
    return day.cast("timestamp_ntz")


def dims(g: Given) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Company, exchange and industry dimension with keys, all rows current."""
    rows = [
        (dimensions.company_rows(g.companies()), "dim_company", "company_key", company_key),
        (dimensions.exchange_rows(g.exchanges(), g.regions()), "dim_exchange", "exchange_key", exchange_key),
        (
            dimensions.industry_rows(g.companies(), g.industries(), g.sics()),
            "dim_industry",
            "industry_key",
            industry_key,
        ),
    ]
    company, exchange, industry = (
        assign_keys(df, list(natural().values()), key)
        .withColumn("is_current", F.lit(True))
        .select(*SCHEMAS[table].names)
        for df, table, key, natural in rows
    )
    return company, exchange, industry


def fact(g: Given) -> DataFrame:
    """The daily fact."""
    keys = ticker_keys(g.companies(), g.exchanges(), g.industries(), *dims(g))
    return daily_fact(g.bars(), keys, keys_bound=g.companies())


@query
def fact_stock_daily(g: Given) -> DataFrame:
    return plain(fact(g))


@query
def dim_date(g: Given) -> DataFrame:
    return dimensions.date_rows(g.raw_bars())


@query
def dim_company(g: Given) -> DataFrame:
    return dimensions.company_rows(g.companies_relisted())


@query
def dim_exchange(g: Given) -> DataFrame:
    return dimensions.exchange_rows(g.exchanges(), g.regions())


@query
def dim_industry(g: Given) -> DataFrame:
    return dimensions.industry_rows(g.companies(), g.industries(), g.sics())


@query
def bars_dedup_first(g: Given) -> DataFrame:
    return g.bars()


def placed_bars(g: Given) -> DataFrame:
    """All bars as a feed; the places in the files follow the order of the first-wins rule."""
    file = F.concat_ws("_", F.lpad(F.col("l_orderkey").cast("string"), 12, "0"), F.col("l_linenumber").cast("string"), F.lpad(F.col("l_partkey").cast("string"), 12, "0"))
    absent = {c: F.lit(None).cast(SCHEMAS["bars"][c].dataType) for c in ("vwap", "transactions", "otc")}
    rows = g.raw_bars().withColumns(absent | {"file": file, "pos": (F.col("open") * 100).cast("int"), "millis": F.unix_millis(F.col("timestamp").cast("timestamp"))})
    return rows.select("l_orderkey", *[c for c in KEPT_SCHEMA.names if c != "trading_day"])


@query
def bars_by_day_batches(g: Given) -> DataFrame:
    """Bars brought into the lake in two batches that share days, the second with bars that come before held ones."""
    folder = scratch_dir(g.spark, "lake")
    store, table = Store(g.spark, f"{folder}/batches"), bar_table(g.spark, folder)
    feed = placed_bars(g)
    for late in (True, False):
        merge_bars(table, store.stage("batch", dated(feed.where((F.col("l_orderkey") % 3 == 0) != late)), kept=1))
    return table.read().select("ticker", "timestamp", "open", "close", "high", "low", "volume")


def land_lines(feed: DataFrame, order: list[str], told: list[str | Column], folder: str, rows: int = LANDED_ROWS) -> int:
    """Write a feed as JSON lines whose files and lines follow an order; returns the files asked for, one for so many rows."""
    count = max(LANDED_FILES, -(-feed.count() // rows))
    feed.repartitionByRange(count, *order).sortWithinPartitions(*order).select(*told).write.json(folder)
    return count


@query
def bars_from_lines(g: Given) -> DataFrame:
    """Bars landed as JSON lines and read back by splits."""
    folder = scratch_dir(g.spark, "lines")
    order = ["l_orderkey", "file", "pos"]
    told = ["ticker", "open", "close", "high", "low", "volume", F.col("millis").alias("timestamp")]
    land_lines(placed_bars(g), order, told, f"{folder}/bars")
    store = Store(g.spark, f"{folder}/staged")
    lines = store.stage("lines", landing.landing_lines(g.spark, f"{folder}/bars", landing.ARRAYS))
    kept = first_bars(landing.bar_feed(landing.line_records(lines)))
    return kept.select("ticker", "timestamp", "open", "close", "high", "low", "volume")


def bar_texts(g: Given) -> DataFrame:
    """A JSON array of one bar per event, under long or short keys; some texts are broken."""
    key = F.col("event_id")
    long = key % 2 == 0
    value = F.get_json_object("props", "$.k")

    def name(full: str, short: str) -> Column:
        return F.when(long, full).otherwise(short)

    parts = [
        F.lit('[{"'),
        name("open", "o"),
        F.lit('":'),
        value,
        F.lit(',"'),
        name("volume", "v"),
        F.lit('":'),
        value,
        F.lit('.5,"'),
        name("timestamp", "t"),
        F.lit('":'),
        (key * 86_400_123).cast("string"),
        F.lit(',"'),
        name("transactions", "n"),
        F.lit('":'),
        key.cast("string"),
        F.when(key % 10 == 4, ',"ticker":null,"T":"HIDDEN"').otherwise(
            F.concat(F.lit(',"'), name("ticker", "T"), F.lit('":"'), "event_type", F.lit('"'))
        ),
        F.when(key % 3 == 1, ',"otc":null').when(key % 3 == 2, ',"otc":true').otherwise(""),
        F.when(key % 17 == 0, "").otherwise("}]"),
    ]
    return g.table("events").select("event_id", F.concat(*parts).alias("value"))


@query
def bars_unreadable(g: Given) -> DataFrame:
    return landing.unreadable(bar_texts(g))


@query
def bars_key_fallback(g: Given) -> DataFrame:
    return landing.bar_feed(landing.records(bar_texts(g))).drop("pos")


@query
def price_trend_by_bar(g: Given) -> DataFrame:
    change = F.col("close") - F.col("open")
    return plain(
        g.raw_bars().select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "ticker",
            money(change).alias("price_change"),
            price_trend(change).alias("price_trend"),
        )
    )


@query
def exchange_explode(g: Given) -> DataFrame:
    return normalize.exchanges(g.markets())


@query
def exchanges_first_wins(g: Given) -> DataFrame:
    return normalize.exchanges(g.market_feed())


@query
def regions_first_wins(g: Given) -> DataFrame:
    return normalize.regions(g.market_feed())


@query
def industries_first_wins(g: Given) -> DataFrame:
    feed = g.table("part").select(
        F.col("p_partkey").alias("pos"),
        F.when(F.col("p_partkey") % 10 == 3, "").when(F.col("p_partkey") % 9 != 0, F.col("p_type")).alias("sector"),
        F.when(F.col("p_partkey") % 8 != 0, F.col("p_brand")).otherwise("").alias("industry"),
    )
    return normalize.industries(feed)


@query
def sic_first_wins(g: Given) -> DataFrame:
    feed = g.table("part").select(
        F.col("p_partkey").alias("pos"),
        F.when(F.col("p_partkey") % 8 != 0, F.col("p_size").cast("string")).alias("sic"),
        F.when(F.col("p_partkey") % 5 != 0, F.col("p_type")).alias("sicSector"),
        F.col("p_brand").alias("sicIndustry"),
    )
    return normalize.sic_industries(feed)


@query
def sic_int_cast(g: Given) -> DataFrame:
    key = F.col("p_partkey")
    digits = F.regexp_extract("p_brand", r"(\d+)", 1)
    text = (
        F.when(key % 6 == 1, "")
        .when(key % 6 == 2, F.concat(digits, F.lit("x")))
        .when(key % 6 == 3, F.concat(F.lit(" "), digits, F.lit(" ")))
        .when(key % 6 == 4, F.concat(digits, F.lit(".0")))
        .when(key % 6 == 5, F.concat(digits, F.lit("99999999999")))
        .otherwise(digits)
    )
    feed = g.table("part").select(
        key.alias("pos"), text.alias("sic"), F.col("p_type").alias("sicIndustry"), F.lit("S").alias("sicSector")
    )
    return resolve_sic(feed).select("pos", "sic_id", "disposition", "reason")


@query
def markets_envelope(g: Given) -> DataFrame:
    key = F.col("c_custkey")
    entry = F.struct(
        F.col("c_mktsegment").alias("region"),
        F.lit("Equity").alias("market_type"),
        F.col("c_name").alias("primary_exchanges"),
        F.when(key % 2 == 0, "09:30").alias("local_open"),
    )
    listed = F.to_json(F.array(entry, entry))
    text = (
        F.when(key % 7 == 0, "{}")
        .when(key % 11 == 0, '{"markets": []}')
        .otherwise(F.concat(F.lit('{"endpoint": "status", "markets": '), listed, F.lit("}")))
    )
    texts = g.table("customer").select("c_custkey", text.alias("value"))
    return landing.market_feed(landing.records(landing.market_texts(texts)))


@query
def company_projection(g: Given) -> DataFrame:
    feed = g.company_feed()
    other = F.struct(F.col("id"), F.lit("x").alias("unused"))
    listed = F.concat(
        F.lit("["), F.to_json(F.struct(*landing.COMPANY_FIELDS)), F.lit(","), F.to_json(other), F.lit("]")
    )
    texts = feed.select(listed.alias("value"))
    return normalize.companies(landing.company_feed(landing.records(texts))).drop("cusip")


@query
def companies_per_exchange_limit(g: Given) -> DataFrame:
    feed = g.table("customer").select(
        F.col("c_custkey").alias("pos"), "c_name", F.col("c_mktsegment").alias("exchange")
    )
    return normalize.limit_per_exchange(feed, 250, 5)


@query
def company_lists_union(g: Given) -> DataFrame:
    rows = g.table("customer").select(F.col("c_custkey").alias("pos"), "c_name", "c_mktsegment")
    # One list per segment.
    segments = sorted(s for (s,) in rows.select("c_mktsegment").where("c_mktsegment IS NOT NULL").distinct().collect())
    lists = [rows.where(F.col("c_mktsegment") == segment) for segment in segments]
    return normalize.join_lists(lists, None)


def exchange_batch(g: Given) -> DataFrame:
    """An exchange per supplier, some without name, some of an unknown region."""
    key = F.col("s_suppkey")
    rows = g.table("supplier").join(g.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    named = rows.join(g.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return named.select(
        key.alias("pos"),
        F.when(key % 13 == 0, "").otherwise(F.col("s_name")).alias("name"),
        F.when(key % 17 == 0, "NOWHERE").when(key % 19 == 0, F.lower("r_name")).otherwise(F.col("r_name")).alias("region"),
    )


@query
def resolve_exchange_rows(g: Given) -> DataFrame:
    rows = resolve_exchanges(exchange_batch(g), g.regions())
    return rows.select("pos", "exchange_name", "region", "exchange_region_id", "disposition", "reason")


def company_batch(g: Given) -> DataFrame:
    """The company feed resolved against the source tables."""
    return resolve_companies(
        g.company_feed(), g.loaded_exchanges(), g.industries(), g.sics(), g.loaded_companies()
    )


@query
def resolve_company_rows(g: Given) -> DataFrame:
    return company_batch(g).select(
        "pos",
        "company_ticker",
        "company_is_delisted",
        "company_exchange_id",
        "company_industry_id",
        "company_sic_id",
        "known",
        "disposition",
        "reason",
    )


@query
def load_dispositions(g: Given) -> DataFrame:
    markets, feed = g.market_feed(), g.company_feed()
    parts = {
        "regions": resolve_regions(normalize.regions(markets)),
        "industries": resolve_industries(normalize.industries(feed)),
        "exchanges": resolve_exchanges(exchange_batch(g), g.regions()),
        "companies": company_batch(g),
    }
    counts = [disposition_counts(entity, rows) for entity, rows in parts.items()]
    return quality.report(counts)


@query
def upsert_regions(g: Given) -> DataFrame:
    key = F.col("c_custkey")
    old = g.table("customer").where(key % 2 == 0).select(
        (key + 1).cast("int").alias("region_id"),
        F.col("c_name").alias("region_name"),
        F.col("c_mktsegment").alias("region_market_type"),
        F.lit("09:30:00").alias("region_local_open"),
        F.lit("16:00:00").alias("region_local_close"),
    )
    new = g.table("customer").where((key % 2 == 1) | (key % 3 == 0)).select(
        F.col("c_name").alias("region_name"),
        F.lit("Equity").alias("region_market_type"),
        F.lit("08:00:00").alias("region_local_open"),
        F.when(key % 9 != 0, "17:00:00").alias("region_local_close"),
    )
    columns = ["region_market_type", "region_local_open", "region_local_close"]
    return upsert(old, new, ["region_name"], columns, "region_id")


@query
def upsert_exchanges(g: Given) -> DataFrame:
    key = F.col("c_custkey")
    old = g.table("customer").where(key % 2 == 0).select(
        (key + 1).cast("int").alias("exchange_id"),
        (F.col("c_nationkey") + 1).alias("exchange_region_id"),
        F.col("c_name").alias("exchange_name"),
    )
    new = g.table("customer").where((key % 2 == 1) | (key % 3 == 0)).select(
        F.col("c_name").alias("exchange_name"),
        ((F.col("c_nationkey") + 1) % 25 + 1).alias("exchange_region_id"),
    )
    return upsert(old, new, ["exchange_name"], ["exchange_region_id"], "exchange_id")


def sic_pair(key: Column) -> list[Column]:
    """A pair of SIC names no two keys share."""
    return [
        F.concat(F.lit("I"), key.cast("string")).alias("sic_industry"),
        F.concat(F.lit("S"), (key % 7).cast("string")).alias("sic_sector"),
    ]


@query
def upsert_sic_codes(g: Given) -> DataFrame:
    key = F.col("p_partkey")
    part = g.table("part")
    old = part.where(key % 2 == 0).select(key.cast("int").alias("sic_id"), *sic_pair(key))
    # The pair of another old row, one pair shared by many new rows, or a pair of its own.
    source = F.when(key % 5 == 0, key - key % 2 + 2).when(key % 7 == 0, -7).otherwise(-key - 100)
    new = part.where((key % 2 == 1) | (key % 3 == 0)).select(key.alias("pos"), key.cast("int").alias("sic_id"), *sic_pair(source))
    return upsert_sic(old, new)


@query
def insert_industries(g: Given) -> DataFrame:
    pairs = g.table("part").select(
        F.col("p_brand").alias("industry_name"), F.col("p_type").alias("industry_sector")
    )
    new = pairs.distinct()
    old = assign_keys(
        new.where(F.length("industry_name") % 2 == 0),
        [F.col("industry_name"), F.col("industry_sector")],
        "industry_id",
    ).select("industry_id", "industry_name", "industry_sector")
    return insert_absent(old, new, ["industry_name", "industry_sector"], "industry_id")


@query
def companies_insert_update(g: Given) -> DataFrame:
    return merge_companies(g.loaded_companies(), company_batch(g))


@query
def dim_date_insert_absent(g: Given) -> DataFrame:
    days = dimensions.date_rows(g.raw_bars())
    old = days.where("year < 1999").withColumn("is_holiday", F.lit(True))
    return insert_absent(old, days, ["date_key"])


@query
def fact_replace_days(g: Given) -> DataFrame:
    old = fact(g)
    touched = dimensions.date_rows(g.raw_bars()).where("date_key % 5 = 0").select("date_key")
    fresh = old.where("date_key % 10 = 5").withColumn("volume", F.col("volume") + 1)
    return plain(replace_days(old, fresh, touched))


@query
def fact_publish_days(g: Given) -> DataFrame:
    """All days are loaded, then some are replaced and some emptied, each load checked and swapped in."""
    folder = scratch_dir(g.spark, "fact")
    store = Store(g.spark, f"{folder}/warehouse")
    tables = {t: store.stage(t, df) for t, df in source_tables(g).items() if t in [*DIMENSIONS, FACT]}
    sizes, parents = sizes_of(dimensions.days(g.raw_bars())), references_of(tables, FACT)
    tasks, _ = spread(sizes, g.spark.sparkContext.defaultParallelism)
    rows = tables[FACT].repartition(tasks, "date_key")
    write_days(rows, fact_path(store), sizes, parents)
    touched = {day: n for day, n in sizes.items() if day % 5 == 0}
    fresh = rows.where("date_key % 10 = 5").withColumn("volume", F.col("volume") + 1)
    write_days(fresh, fact_path(store), touched, parents)
    return plain(read_fact(g.spark, fact_path(store)))


@query
def fact_null_purge(g: Given) -> DataFrame:
    holes = fact(g).withColumn("company_key", F.when(F.col("company_key") % 10 != 0, F.col("company_key")))
    return plain(drop_null_keys(holes))


def company_versions(g: Given) -> tuple[DataFrame, DataFrame]:
    """A loaded company dimension, and the rows of the next load: some changed, new or absent; every company is in one of them."""
    first = dimensions.company_rows(g.companies().where("company_id % 7 <> 3"))
    loaded = assign_keys(first, list(company_key().values()), "company_key")
    dim = loaded.withColumn("is_current", F.lit(True)).select(*SCHEMAS["dim_company"].names)
    moved = g.companies().where("company_id % 11 <> 4 OR company_id % 7 = 3").withColumn(
        "company_location", F.when(F.col("company_id") % 5 == 0, "Moved").otherwise(F.col("company_location"))
    )
    return dim, dimensions.company_rows(moved)


@query
def dims_append_current(g: Given) -> DataFrame:
    return append_current(*company_versions(g), company_key, "company_key")


@query
def dims_scd2(g: Given) -> DataFrame:
    return expire_and_insert(*company_versions(g), company_key, "company_key")


@query
def surrogate_keys(g: Given) -> DataFrame:
    rows = g.table("customer").select("c_name", F.col("c_custkey").cast("int").alias("id"))
    added = assign_keys(
        rows.where("id % 2 = 1").select("c_name"), [F.col("c_name")], "id", rows.where("id % 2 = 0")
    )
    return added.select("c_name", "id")


def order_snapshots(g: Given) -> DataFrame:
    """Orders under the month of their date as snapshot, as told by a file name."""
    month = F.trunc("o_orderdate", "month")
    name = F.concat(F.lit("orders_"), token_of(month), F.lit(".parquet"))
    return g.table("orders").select("o_orderkey", "o_custkey", "o_totalprice", date_token(name).alias("token"))


@query
def latest_snapshot(g: Given) -> DataFrame:
    return only_latest(order_snapshots(g), "token").withColumn(
        "snapshot_date", as_time(token_date(F.col("token")))
    )


@query
def trading_date_rollback(g: Given) -> DataFrame:
    days = g.table("orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    day = F.col("d")
    return days.select(
        as_time(day).alias("today"),
        as_time(trading_day(day, 1)).alias("trading_day"),
        as_time(trading_day(day, 3)).alias("trading_day_3"),
        as_time(landing_day(day)).alias("landing_day"),
    )


@query
def time_of_day_texts(g: Given) -> DataFrame:
    nanos = F.when(F.col("o_orderkey") % 11 != 0, (F.col("o_orderkey") * 7919 % 86400) * 1_000_000_000 + 999)
    spelled = F.concat(F.lit("0 days "), time_of_day(nanos), F.lit(".5"))
    return g.table("orders").select(
        "o_orderkey",
        time_of_day(nanos).alias("local_open"),
        clock_text(F.when(F.col("o_orderkey") % 13 != 0, spelled).otherwise("NaT")).alias("spelled"),
    )


def source_tables(g: Given) -> dict[str, DataFrame]:
    """The bound source tables and warehouse tables by name."""
    company, exchange, industry = dims(g)
    return {
        "regions": g.regions(),
        "industries": g.industries(),
        "sicindustries": g.sics(),
        "exchanges": g.exchanges(),
        "companies": g.companies(),
        "dim_date": dimensions.date_rows(g.raw_bars()),
        "dim_company": company,
        "dim_industry": industry,
        "dim_exchange": exchange,
        "fact_stock_daily": fact(g),
    }


@query
def quality_not_null(g: Given) -> DataFrame:
    return quality.report([quality.not_null(df, t, REQUIRED[t]) for t, df in source_tables(g).items()])


@query
def quality_unique(g: Given) -> DataFrame:
    tables = source_tables(g)
    tables["companies"] = g.companies().withColumn("company_ticker", F.substring("company_ticker", 1, 6))
    return quality.report(
        [quality.unique(tables[t], t, key) for t, keys in UNIQUE.items() for key in keys]
    )


@query
def quality_foreign_keys(g: Given) -> DataFrame:
    tables = source_tables(g)
    children = sorted({child for child, _ in FOREIGN})
    return quality.report(
        [quality.foreign_keys(tables[t], t, references_of(tables, t)) for t in children]
    )


@query
def quality_length(g: Given) -> DataFrame:
    bounds = LENGTHS["companies"]
    feed = g.company_feed().select(*[F.col(c.removeprefix("company_")).alias(c) for c in bounds])
    return quality.report(
        [
            quality.max_length(feed, "companies", bounds),
            quality.max_length(g.table("customer"), "customer", {"c_name": 10, "c_mktsegment": 9}),
        ]
    )


@query
def table_counts(g: Given) -> DataFrame:
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
    tables = {n: g.table(n) for n in names} | {"fact_stock_daily": fact(g)}
    return quality.row_counts(tables)


@query
def parquet_roundtrip(g: Given) -> DataFrame:
    folder = scratch_dir(g.spark, "bars")
    for token, rows in [("2024_01_01", g.raw_bars().limit(0)), ("2024_01_02", g.bars())]:
        write_snapshot(rows, folder, "snapshot_date", token)
    return read_snapshot(g.spark, folder, "snapshot_date", g.bars().schema)


@query
def json_roundtrip(g: Given) -> DataFrame:
    folder = scratch_dir(g.spark, "exchanges")
    rows = normalize.exchanges(g.market_feed())
    write_json(rows, folder, "snapshot_date", "2024_01_02")
    back = g.spark.read.schema(rows.schema).json(f"{folder}/snapshot_date=2024_01_02")
    return back


@query
def retention_latest(g: Given) -> DataFrame:
    """A snapshot per calendar year, all written by one job; all but the latest are removed, the rest is read."""
    folder = scratch_dir(g.spark, "orders")
    rows = g.table("orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    write_snapshots(rows.withColumn("snapshot_date", F.concat(F.col("year").cast("string"), F.lit("_01_01"))), folder, "snapshot_date")
    keep_latest(g.spark, folder, "snapshot_date")
    return read_all_snapshots(g.spark, folder, rows.schema).drop("snapshot_date")


@query
def source_load(g: Given) -> DataFrame:
    """The whole source job, from feeds to tables, and the companies read back with their names."""
    feed = g.company_feed().withColumns(
        {
            "exchange": F.when(F.col("exchange").isin("", "UNKNOWN"), F.col("exchange"))
            .when(F.col("category").isNotNull(), F.concat("category", F.lit(" X")))
            .otherwise("HUB"),
            "sicSector": F.lit("S"),
            "sicIndustry": F.concat(F.lit("I"), "sic"),
        }
    )
    store = Store(g.spark, scratch_dir(g.spark, "source"))
    load_feeds(g.spark, feed, g.market_feed(), store)
    companies, exchanges, industries = (store.read(t) for t in ("companies", "exchanges", "industries"))
    return (
        companies.join(exchanges, F.col("company_exchange_id") == F.col("exchange_id"))
        .join(industries, F.col("company_industry_id") == F.col("industry_id"), "left")
        .select(
            "company_ticker",
            "company_is_delisted",
            "company_name",
            "company_cik",
            "exchange_name",
            "industry_name",
            "industry_sector",
            "company_sic_id",
            "company_category",
            "company_location",
        )
    )


@query
def warehouse_load(g: Given) -> DataFrame:
    """The whole warehouse job, from lake snapshots to tables, and the fact read back."""
    lake, store = scratch_dir(g.spark, "lake"), Store(g.spark, scratch_dir(g.spark, "warehouse"))
    tables = {
        "regions": g.regions().withColumns(
            {c: time_of_day(F.col(c)) for c in ("region_local_open", "region_local_close")}
        ),
        "exchanges": g.exchanges(),
        "industries": g.industries(),
        "sicindustries": g.sics(),
        "companies": g.companies(),
    }
    snapshot_tables(tables, g.bars(), lake, "2024_01_02")
    load_warehouse(g.spark, lake, store)
    return plain(read_fact(g.spark, fact_path(store)))
