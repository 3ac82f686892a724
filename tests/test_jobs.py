import datetime as dt
import json
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quotemart.operators.quality import ConstraintError, require
from quotemart.plans import dimensions, fact
from quotemart.plans.fact import daily_fact, first_bars, ticker_keys
from quotemart.plans.lake import lake_bars
from quotemart.plans.jobs import (
    constraints,
    init_warehouse,
    load_dimensions,
    load_fact,
    load_feeds,
    load_source,
    load_warehouse,
    publish,
    snapshot_tables,
)
from quotemart.schemas import DIMENSIONS, FACT, SCHEMAS, SOURCE_TABLES
from quotemart.sinks import fact as fact_sink
from quotemart.sinks.snapshots import keep_latest, write_snapshot, write_snapshots
from quotemart.sinks.store import Store, fact_path
from quotemart.sources import database, files
from quotemart.sources.landing import read_bars
from quotemart.sources.snapshots import read_snapshot, snapshot_tokens
from quotemart.streaming.daily import follow_bars

MARKETS = {
    "markets": [
        {"region": "United States", "market_type": "Equity", "local_open": "09:30", "local_close": "16:00", "primary_exchanges": "NYSE, NASDAQ"},
        {"region": "Canada", "market_type": "Equity", "local_open": "09:30", "local_close": "16:00", "primary_exchanges": "Toronto, NYSE"},
        {"region": "Nowhere", "market_type": "Equity", "local_open": "soon", "local_close": "16:00", "primary_exchanges": "Moon"},
    ]
}


def company(ticker, exchange="NYSE", **more):
    base = {
        "name": f"{ticker} Inc",
        "ticker": ticker,
        "cik": "1",
        "exchange": exchange,
        "isDelisted": False,
        "category": "Common",
        "sector": "Tech",
        "industry": "Chips",
        "sic": "3674",
        "sicSector": "Manufacturing",
        "sicIndustry": "Semiconductors",
        "currency": "USD",
        "location": "CA",
    }
    return base | more


COMPANIES = [
    company("AAA"),
    company("BBB", "NASDAQ", sector="Money", industry="Banks", sic="6021", sicIndustry="Banks", sicSector="Finance"),
    company("CCC", "Moon"),
    company("DDD", ""),
    company("EEE", sector="Gas", sic=None),
    company("AAA", isDelisted=True, location="Old"),
    company("FFF", industry=None),
]


def bar(ticker, day, opened, closed, **more):
    at = dt.datetime.fromisoformat(day).replace(hour=20, tzinfo=dt.timezone.utc)
    return {"T": ticker, "o": opened, "h": max(opened, closed), "l": min(opened, closed), "c": closed, "v": 10.9, "t": int(at.timestamp() * 1000)} | more


BARS = {
    "crawl_ohlcs_2024_01_02.json": [
        bar("AAA", "2024-01-02", 1.0, 2.0),
        bar("bbb ", "2024-01-02", 2.0, 1.0),
        bar("ZZZ", "2024-01-02", 1.0, 1.0),
    ],
    "crawl_ohlcs_2024_01_03.json": [
        bar("AAA", "2024-01-03", 1.0, 1.0),
        bar("AAA", "2024-01-03", 7.0, 8.0),
        bar("EEE", "2024-01-03", 5.0, 5.00001),
    ],
}


@pytest.fixture
def landing(land, tmp_path):
    land("landing/markets", "crawl_markets_2024_01_01.json", MARKETS)
    land("landing/companies", "crawl_companies_2024_01_01.json", COMPANIES)
    for name, bars in BARS.items():
        land("landing/bars", name, bars)
    return str(tmp_path / "landing")


@pytest.fixture
def store(spark, folder):
    return Store(spark, folder("source"))


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """Source tables and lake, loaded once; tests leave both as they are."""
    root = tmp_path_factory.mktemp("loaded")
    feeds = {"markets": {"m.json": MARKETS}, "companies": {"c.json": COMPANIES}, "bars": BARS}
    for kind, contents in feeds.items():
        (root / "landing" / kind).mkdir(parents=True)
        for name, content in contents.items():
            (root / "landing" / kind / name).write_text(json.dumps(content), encoding="utf-8")
    source = Store(spark, str(root / "source"))
    load_source(spark, str(root / "landing"), source)
    assert publish(spark, str(root / "landing"), source, str(root / "lake"), "2024_01_04")["bars"] == 5
    return source, str(root / "lake")


@pytest.fixture
def warehouse(spark, folder):
    return Store(spark, folder("warehouse"))


def fact_view(spark, warehouse):
    """The fact with readable names instead of keys."""
    names = [
        ("dim_company", "company_key", "company_ticker"),
        ("dim_exchange", "exchange_key", "exchange_name"),
        ("dim_industry", "industry_key", "industry_sector"),
    ]
    df = fact_sink.read_fact(spark, fact_path(warehouse))
    for table, key, name in names:
        df = df.join(warehouse.read(table).select(key, name), key)
    return df.select("date_key", "company_ticker", "exchange_name", "industry_sector", F.col("close_price").cast("double"), "volume", "price_trend")


FACT_ROWS = [
    (20240102, "AAA", "NYSE", "Tech", 2.0, 10, "up"),
    (20240102, "BBB", "NASDAQ", "Money", 1.0, 10, "down"),
    (20240103, "AAA", "NYSE", "Tech", 1.0, 10, "unchanged"),
    (20240103, "EEE", "NYSE", "Gas", 5.0, 10, "up"),
]


def test_source_load_and_rerun(spark, landing, store, rows, folder):
    processed = folder("processed")
    counts = load_source(spark, landing, store, processed, "2024_01_02")
    assert rows(counts) == [
        ("companies", "error", 1),
        ("companies", "inserted", 5),
        ("companies", "skipped", 1),
        ("exchanges", "error", 1),
        ("exchanges", "inserted", 3),
        ("industries", "inserted", 3),
        ("regions", "inserted", 2),
        ("regions", "skipped", 1),
        ("sicindustries", "inserted", 2),
    ]
    first = {t: rows(store.read(t)) for t in SOURCE_TABLES}
    exchange = store.read("exchanges").where("exchange_name = 'NYSE'").first()["exchange_region_id"]
    region = store.read("regions").where(F.col("region_id") == exchange).first()["region_name"]
    assert region == "United States"
    rejects = spark.read.parquet(f"{store.path('audit/companies')}/version=000000001").where("reason IS NOT NULL")
    assert rows(rejects, "company_ticker", "reason") == [("CCC", "unknown exchange"), ("DDD", "no exchange")]
    assert spark.read.json(f"{processed}/exchanges").count() == 4

    counts = load_source(spark, landing, store, processed, "2024_01_03")
    assert ("companies", "updated", 5) in rows(counts)
    assert {t: rows(store.read(t)) for t in SOURCE_TABLES} == first
    assert files.names(spark, f"{processed}/regions") == ["snapshot_date=2024_01_03"]


def test_warehouse_load_and_rerun(spark, loaded, warehouse, rows):
    lake = loaded[1]
    init_warehouse(warehouse)
    done = load_warehouse(spark, lake, warehouse)
    assert done == {"rows": 4, "days": 2, "emptied": 0, "dropped": 0}
    assert rows(fact_view(spark, warehouse)) == FACT_ROWS
    first = {t: rows(warehouse.read(t)) for t in DIMENSIONS}
    facts = rows(fact_sink.read_fact(spark, fact_path(warehouse)))
    assert [r[0] for r in first["dim_date"]] == [20240102, 20240103]

    load_warehouse(spark, lake, warehouse)
    assert {t: rows(warehouse.read(t)) for t in DIMENSIONS} == first
    assert rows(fact_sink.read_fact(spark, fact_path(warehouse))) == facts
    tables = {t: warehouse.read(t) for t in DIMENSIONS} | {FACT: fact_sink.read_fact(spark, fact_path(warehouse))}
    require(constraints(tables, [*DIMENSIONS, FACT]))


def test_changed_company_moves_and_an_emptied_day_goes(spark, loaded, warehouse, rows, folder):
    source, old_lake = loaded
    load_warehouse(spark, old_lake, warehouse)

    location = F.when(F.col("company_ticker") == "BBB", "TX").otherwise(F.col("company_location"))
    left = source.read("companies").where("company_ticker NOT IN ('AAA', 'EEE')")
    tables = {t: source.read(t) for t in SOURCE_TABLES}
    tables["companies"] = left.withColumn("company_location", location)
    bars = lake_bars(spark, old_lake)
    lake = folder("lake")
    snapshot_tables(tables, bars, lake, "2024_01_05")
    done = load_warehouse(spark, lake, warehouse)
    assert done == {"rows": 1, "days": 1, "emptied": 1, "dropped": 0}
    assert rows(fact_view(spark, warehouse)) == [(20240102, "BBB", "NASDAQ", "Money", 1.0, 10, "down")]
    versions = rows(warehouse.read("dim_company").where("company_ticker = 'BBB'"), "company_location", "is_current")
    assert versions == [("CA", False), ("TX", True)]


def test_one_trading_date_leaves_other_days_alone(spark, loaded, warehouse, rows):
    lake = loaded[1]
    assert load_warehouse(spark, lake, warehouse, trading_date=20240103)["days"] == 1
    assert rows(fact_view(spark, warehouse)) == FACT_ROWS[2:]
    load_warehouse(spark, lake, warehouse, snapshot="2024_01_04", trading_date=20240102)
    assert rows(fact_view(spark, warehouse)) == FACT_ROWS


def test_append_mode_fans_out_on_a_second_run(spark, loaded, warehouse):
    lake = loaded[1]
    assert load_warehouse(spark, lake, warehouse, append=True)["rows"] == 4
    assert load_warehouse(spark, lake, warehouse, append=True)["rows"] == 4 * 2**3


def test_stream_gives_the_same_fact_as_the_full_load(spark, loaded, landing, land, warehouse, rows, folder):
    source, old_lake = loaded
    tables = {t: source.read(t) for t in SOURCE_TABLES}
    daily = Store(spark, folder("daily"))
    for store in (daily, warehouse):
        load_dimensions(tables, store)
    lake, checkpoint = folder("daily_lake"), folder("checkpoint")

    def follow():
        query = follow_bars(spark, f"{landing}/bars", lake, checkpoint, tables, daily)
        assert query.awaitTermination(120) and query.exception() is None

    follow()
    assert rows(fact_view(spark, daily)) == FACT_ROWS
    land(
        "landing/bars",
        "crawl_ohlcs_2024_01_04.json",
        [bar("AAA", "2024-01-03", 9.0, 9.5), bar("BBB", "2024-01-03", 3.0, 4.0), bar("AAA", "2024-01-04", 1.0, 3.0)],
    )
    follow()
    all_bars = first_bars(read_bars(spark, f"{landing}/bars"))
    load_fact(all_bars, tables, warehouse)
    assert rows(fact_view(spark, daily)) == rows(fact_view(spark, warehouse))
    assert fact_view(spark, warehouse).count() == 6


def test_snapshots(spark, folder, rows):
    table = folder("orders")
    first = spark.createDataFrame([(1, "a")], "id int, name string")
    assert write_snapshot(first, table, "snapshot_date", "2024_01_01") == 1
    assert write_snapshot(first.withColumn("id", F.lit(2)), table, "snapshot_date", "2024_01_02") == 1
    assert write_snapshot(first.limit(0), table, "snapshot_date", "2024_01_03") == 0
    assert snapshot_tokens(spark, table, "snapshot_date") == ["2024_01_01", "2024_01_02"]
    assert rows(read_snapshot(spark, table, "snapshot_date", first.schema)) == [(2, "a")]
    assert rows(read_snapshot(spark, table, "snapshot_date", first.schema, "2024_01_01")) == [(1, "a")]
    files.delete(spark, f"{table}/snapshot_date=2024_01_02/_SUCCESS")
    assert rows(read_snapshot(spark, table, "snapshot_date", first.schema)) == [(1, "a")]
    write_snapshot(first, table, "snapshot_date", "2024_01_04")
    assert keep_latest(spark, table, "snapshot_date") == ["2024_01_01"]
    assert read_snapshot(spark, folder("none"), "snapshot_date", first.schema).count() == 0


def test_parquet_is_snappy_with_microseconds(spark, folder, tmp_path):
    target = folder("bars")
    df = spark.createDataFrame([("A", dt.datetime(2024, 1, 1))], "ticker string, timestamp timestamp_ntz")
    write_snapshot(df.coalesce(1), target, "snapshot_date", "2024_01_01")
    part = next(Path(target).glob("*/*.parquet"))
    column = pq.ParquetFile(part).metadata.row_group(0).column(1)
    assert column.compression == "SNAPPY"
    assert pq.read_schema(part).field("timestamp").type.unit == "us"


def test_constraint_failure_raises(spark, store):
    store.init(SOURCE_TABLES)
    store.write("exchanges", spark.createDataFrame([(1, 99, "NYSE", None)], SCHEMAS["exchanges"]))
    with pytest.raises(ConstraintError, match="exchange_region_id"):
        require(constraints({t: store.read(t) for t in SOURCE_TABLES}, SOURCE_TABLES))


def test_days_are_spread_over_tasks_by_their_size(monkeypatch):
    monkeypatch.setattr(fact_sink, "ROWS_PER_TASK", 10)
    assert fact_sink.spread({}, 4) == (1, 1)
    assert fact_sink.spread({1: 5, 2: 10}, 4) == (2, 1)
    assert fact_sink.spread({1: 1000, 2: 10}, 4) == (101, 100)
    assert fact_sink.spread({k: 10 for k in range(300)}, 4) == (300, 1)


def test_repeated_rows_and_the_write_share_a_shuffle(spark):
    bars = spark.range(2000).select(
        F.concat(F.lit("t"), (F.col("id") % 50).cast("string")).alias("ticker"),
        *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "close", "volume")],
        (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(days=(F.col("id") % 3).cast("int"))).alias("timestamp"),
    )
    keys = spark.range(50).select(F.concat(F.lit("t"), "id").alias("ticker"), F.col("id").cast("int").alias("company_key"), F.lit(1).alias("industry_key"), F.lit(1).alias("exchange_key"))
    got = daily_fact(bars, keys, spread=(16, 8))
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert got.count() == 150 and len(sizes) >= 6 and max(sizes) <= 60


def test_written_days_come_back(spark, folder, rows):
    path = folder("fact")
    fact_sink.init_fact(spark, path)
    df = spark.range(100).select(
        (F.col("id") % 3 + 20240101).cast("int").alias("date_key"),
        *[F.lit(1).alias(c) for c in ("company_key", "industry_key", "exchange_key")],
        *[F.lit(1).cast("decimal(18,4)").alias(c) for c in ("open_price", "high_price", "low_price", "close_price")],
        F.col("id").alias("volume"),
        F.lit(0).cast("decimal(18,4)").alias("price_change"),
        F.lit("unchanged").alias("price_trend"),
    )
    sizes = fact_sink.sizes_of(df.groupBy("date_key").agg(F.count("*").alias("bars")))
    assert fact_sink.write_days(df, path, sizes) == {"rows": 100, "days": 3, "emptied": 0, "dropped": 0}
    assert rows(fact_sink.read_fact(spark, path)) == rows(df.select(*SCHEMAS[FACT].names))


def test_hot_ticker_beyond_the_broadcast_bound(spark, monkeypatch):
    """A third of the bars on one ticker: the shuffled join splits it and the result stays whole."""
    bars = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), (F.col("id") % 500).cast("string"))).alias("ticker"),
        F.lit(1.0).alias("open"),
        (F.col("id") + 2.0).alias("high"),
        F.lit(1.0).alias("low"),
        (F.col("id") + 1.0).alias("close"),
        F.lit(1.0).alias("volume"),
        F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("timestamp"),
    )
    tickers = spark.range(500).select(F.concat(F.lit("t"), "id").alias("ticker")).union(spark.createDataFrame([("hot",)], "ticker string"))
    keys = tickers.select("ticker", F.hash("ticker").alias("company_key"), F.lit(1).alias("industry_key"), F.lit(1).alias("exchange_key"))
    expected = daily_fact(bars, keys).groupBy("company_key").count()
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    wanted = {tuple(r) for r in expected.collect()}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for name, setting in settings.items():
        spark.conf.set(name, setting)
    try:
        monkeypatch.setattr(fact, "lookup_side", lambda df, bound=None, rows=0, size=None: df)
        got = daily_fact(bars, keys).groupBy("company_key").count()
        assert {tuple(r) for r in got.collect()} == wanted
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in settings:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_fan_out_options(spark):
    exchanges = spark.createDataFrame([(1, 1, "NYSE", None)], SCHEMAS["exchanges"])
    industries = spark.createDataFrame([(1, "Chips", "Tech", None), (2, "Chips", "Gas", None)], SCHEMAS["industries"])
    companies = spark.createDataFrame(
        [
            (1, 1, 1, None, "a", "1", "A", False, None, None, None, None),
            (2, 1, 2, None, "a", "1", "a ", True, None, None, None, None),
        ],
        SCHEMAS["companies"],
    )
    dim_company = spark.createDataFrame([(1, "A", "a", None, "1", False, None, True)], SCHEMAS["dim_company"])
    dim_exchange = spark.createDataFrame([(1, " NYSE", None, None, None, None, True)], SCHEMAS["dim_exchange"])
    dim_industry = spark.createDataFrame(
        [(1, "Tech", "Chips", None, None, True), (2, "Gas", "Chips", None, None, True), (3, "Tech", "Chips", None, None, False)],
        SCHEMAS["dim_industry"],
    )
    tables = (companies, exchanges, industries, dim_company, dim_exchange, dim_industry)
    assert [tuple(r) for r in ticker_keys(*tables).collect()] == [("a", 1, 1, 1)]
    assert ticker_keys(*tables, every_listing=True).count() == 2
    assert ticker_keys(*tables, industry_by_name=True).count() == 2
    assert ticker_keys(*tables, every_listing=True, industry_by_name=True).count() == 4


def test_dim_exchange_takes_clock_texts(spark, rows):
    exchanges = spark.createDataFrame([(1, 1, "NYSE ", None), (2, 9, "LSE", None), (3, 1, " NYSE", None)], SCHEMAS["exchanges"])
    regions = spark.createDataFrame([(1, "US", "Equity", "09:30:00", None, None)], SCHEMAS["regions"])
    found = dimensions.exchange_rows(exchanges, regions)
    assert rows(found, "exchange_name", "region_name", "region_local_open", "region_local_close") == [
        ("LSE", None, "00:00:00", "00:00:00"),
        ("NYSE ", "US", "09:30:00", "00:00:00"),
    ]


def test_database_options():
    assert database.bounds_query("companies") == "SELECT MIN(company_id) AS low, MAX(company_id) AS high FROM companies"
    assert database.split_options("regions", None, None, 8) == {"dbtable": "regions"}
    assert database.split_options("regions", 3, 3, 8) == {"dbtable": "regions"}
    assert database.split_options("sicindustries", 1, 9, 4) == {
        "dbtable": "sicindustries",
        "partitionColumn": "sic_id",
        "lowerBound": "1",
        "upperBound": "10",
        "numPartitions": "4",
    }


def test_unreadable_files_are_named_in_every_run(spark, land, tmp_path):
    land("landing/bars", "good.json", [{"T": "A", "t": 1, "o": 1.0, "c": 2.0}])
    land("landing/bars", "bad.json", '[{"T": "B",')
    land("landing/companies", "c.json", '{"ticker": "A"}')
    land("landing/markets", "m.json", {"markets": [{"region": "r", "market_type": "E", "local_open": "09:30", "local_close": "16:00", "primary_exchanges": "X"}]})
    store, landing = Store(spark, str(tmp_path / "source")), str(tmp_path / "landing")
    store.init(SOURCE_TABLES)
    for token in ("2024_01_01", "2024_01_02", "2024_01_03"):
        counts = publish(spark, landing, store, str(tmp_path / "lake"), token)
        assert counts["bars"] == 1 and counts["bars_unreadable"] == 1
    runs = spark.read.parquet(store.path("audit/unreadable"))
    assert [tuple(r) for r in runs.groupBy("feed", "file").count().collect()] == [("bars", "bad.json", 3)]
    found = {(r.entity, r.disposition): r["rows"] for r in load_source(spark, landing, store).collect()}
    assert found["companies", "unreadable"] == 1 and found["regions", "inserted"] == 1 and ("markets", "unreadable") not in found


def test_a_load_that_breaks_a_constraint_leaves_the_former_tables(spark, store):
    store.init(SOURCE_TABLES)
    store.write("exchanges", spark.createDataFrame([(1, 99, "NYSE", None)], SCHEMAS["exchanges"]))
    markets = spark.createDataFrame([(0, "r", "E", "09:30", "16:00", "TSE")], "pos int, region string, market_type string, local_open string, local_close string, primary_exchanges string")
    with pytest.raises(ConstraintError, match="exchange_region_id"):
        load_feeds(spark, None, markets, store)
    assert store.read("regions").count() == 0
    assert [r.exchange_name for r in store.read("exchanges").collect()] == ["NYSE"]


def test_snapshots_of_one_job_replace_their_own_tokens_only(spark, tmp_path):
    table = str(tmp_path / "snapshots")
    make = lambda rows: spark.createDataFrame(rows, "x int, snapshot_date string")
    assert write_snapshots(make([(1, "2024_01_01"), (2, "2024_01_02"), (3, "2024_01_02")]), table, "snapshot_date") == ["2024_01_01", "2024_01_02"]
    assert write_snapshots(make([(4, "2024_01_02"), (5, "2024_01_03")]), table, "snapshot_date") == ["2024_01_02", "2024_01_03"]
    assert snapshot_tokens(spark, table, "snapshot_date") == ["2024_01_01", "2024_01_02", "2024_01_03"]
    assert sorted(tuple(r) for r in spark.read.parquet(table).select("x").collect()) == [(1,), (4,), (5,)]
    with pytest.raises(Exception, match="rows without snapshot_date"):
        write_snapshots(make([(6, None)]), table, "snapshot_date")
    assert keep_latest(spark, table, "snapshot_date") == ["2024_01_01", "2024_01_02"]
    assert write_snapshots(make([]), table, "snapshot_date") == []
