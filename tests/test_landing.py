import datetime as dt
import json
import os
from pathlib import Path

from pyspark.sql import functions as F

from quotemart.checks.queries import land_lines
from quotemart.operators.resolve import resolve_industries, resolve_regions, resolve_sic
from quotemart.plans import normalize
from quotemart.plans.fact import first_bars
from quotemart.sources import landing


def test_key_fallback_fires_on_absent_keys_only(spark, land, rows):
    folder = land("bars", "a.json", [{"T": "A", "t": 1}, {"ticker": "C", "timestamp": 3}, {"ticker": None, "T": "D"}])
    feed = landing.read_bars(spark, folder)
    assert rows(feed, "pos", "ticker", "millis") == [(0, "A", 1), (1, "C", 3), (2, None, None)]
    assert feed.where("pos = 0").first()["timestamp"] == dt.datetime(1970, 1, 1, 0, 0, 0, 1000)


def test_broken_file_is_dropped_alone_and_whole(spark, land, rows):
    land("bars", "a.json", '[{"T":"A","t":1},{"T":"B",')
    land("bars", "c.json", '{"T":"E"}')
    land("bars", "d.txt", '[{"T":"F"}]')
    folder = land("bars", "b.json", [{"T": "C", "t": 1}])
    assert rows(landing.read_bars(spark, folder), "file", "ticker") == [("b.json", "C")]
    assert rows(landing.unreadable(landing.landing_texts(spark, folder))) == [("a.json",), ("c.json",)]


def test_otc_default_and_types(spark, land, rows):
    folder = land(
        "bars",
        "a.json",
        [
            {"T": "A", "o": 1, "v": 2.5, "n": 7},
            {"T": "B", "otc": None, "o": "x"},
            {"T": "C", "otc": True, "n": None},
        ],
    )
    feed = landing.read_bars(spark, folder)
    assert rows(feed, "ticker", "open", "volume", "transactions", "otc") == [
        ("A", 1.0, 2.5, 7, False),
        ("B", None, None, None, None),
        ("C", None, None, None, True),
    ]


def test_bar_duplicates_keep_the_first_file_and_position(spark, land, rows):
    land("bars", "crawl_2024_01_02.json", [{"T": "A", "t": 1, "c": 3}, {"T": None, "t": 1, "c": 9}])
    folder = land(
        "bars",
        "crawl_2024_01_01.json",
        [{"T": "A", "t": 1, "c": 1}, {"T": "A", "t": 1, "c": 2}, {"T": None, "t": 1, "c": 8}, {"T": "A", "t": 2, "c": 4}],
    )
    kept = first_bars(landing.read_bars(spark, folder))
    assert rows(kept, "ticker", "close") == [("A", 1.0), ("A", 4.0), (None, 8.0)]


def test_latest_file_by_modification_time(spark, land):
    folder = land("companies", "z_old.json", [{"name": "old"}])
    land("companies", "a_new.json", [{"name": "new"}])
    os.utime(f"{folder}/z_old.json", (1_000_000, 1_000_000))
    os.utime(f"{folder}/a_new.json", (2_000_000, 2_000_000))
    land("companies", ".hidden.json", [{"name": "hidden"}])
    assert landing.latest_file(spark, folder).endswith("/a_new.json")
    assert [r["name"] for r in landing.read_companies(spark, folder).collect()] == ["new"]


def test_empty_folder_gives_nothing(spark, tmp_path):
    assert landing.read_companies(spark, str(tmp_path)) is None
    assert landing.read_markets(spark, str(tmp_path)) is None


def test_market_envelope_and_bare_array(spark, land, rows):
    entry = {"region": "US", "primary_exchanges": "NYSE"}
    for name, content in [("e", {"markets": [entry]}), ("b", [entry]), ("n", {"note": "limit reached"})]:
        feed = landing.read_markets(spark, land(name, "m.json", content))
        found = rows(feed, "region", "primary_exchanges", "local_open")
        assert found == ([] if name == "n" else [("US", "NYSE", "")])


def test_company_projection(spark, land):
    folder = land("companies", "c.json", [{"ticker": "A", "isDelisted": True, "sic": "7372", "extra": 1}, {}])
    feed = landing.read_companies(spark, folder)
    projected = normalize.companies(feed)
    assert projected.columns == landing.COMPANY_FIELDS
    first, second = projected.collect()
    assert (first["ticker"], first["isDelisted"], first["sic"], first["name"]) == ("A", True, "7372", None)
    assert all(v is None for v in second)


def test_first_wins_entities(spark, rows):
    markets = spark.createDataFrame(
        [
            (0, "r1", "Equity", "09:30", "16:00", "NYSE, NASDAQ,, \tAMEX\n"),
            (1, "r2", "Equity", "08:00", "17:00", "NASDAQ, LSE, LSE"),
            (2, "r1", "Forex", "00:00", "23:59", ""),
            (3, "", "Equity", "", "", "TSE"),
        ],
        "pos int, region string, market_type string, local_open string, local_close string, primary_exchanges string",
    )
    assert rows(normalize.regions(markets), "region", "market_type") == [("r1", "Equity"), ("r2", "Equity")]
    assert rows(normalize.exchanges(markets), "name", "region") == [
        ("AMEX", "r1"),
        ("LSE", "r2"),
        ("NASDAQ", "r1"),
        ("NYSE", "r1"),
        ("TSE", ""),
    ]
    feed = spark.createDataFrame(
        [
            (0, "1", "Tech", "Chips", "s0", "i0"),
            (1, "1", "Tech", "Chips", "s1", "i1"),
            (2, "", "Tech", "", "s2", "i2"),
            (3, None, None, "Chips", None, None),
            (4, "2", "Gas", "Chips", None, "i4"),
        ],
        "pos int, sic string, sector string, industry string, sicSector string, sicIndustry string",
    )
    assert rows(normalize.sic_industries(feed), "sic", "sicSector", "sicIndustry") == [("1", "s0", "i0"), ("2", None, "i4")]
    assert rows(normalize.industries(feed), "sector", "industry") == [("Gas", "Chips"), ("Tech", "Chips"), (None, "Chips")]


def test_limit_per_exchange(spark, rows):
    feed = spark.createDataFrame([(i, "AB"[i % 2]) for i in range(10)], "pos int, exchange string")
    assert rows(normalize.limit_per_exchange(feed, 5, 2)) == [(0, "A"), (1, "B"), (2, "A"), (3, "B")]
    for no_limit in (None, 0, -1):
        assert normalize.limit_per_exchange(feed, no_limit, 2).count() == 10


def test_null_is_kept_and_absent_is_empty(spark, rows, land):
    listed = [
        {"ticker": "A", "sic": "1", "industry": "X", "sector": None, "sicSector": None, "isDelisted": "no"},
        {"ticker": "B", "sic": "2", "industry": "X", "isDelisted": 0},
        {"ticker": "C", "sic": "3", "industry": "X", "sector": "S", "sicSector": "T", "sicIndustry": "I", "isDelisted": 2},
        {"ticker": "D"},
    ]
    folder = land("companies", "c.json", listed)
    feed = landing.read_companies(spark, folder)
    assert rows(feed, "ticker", "sector", "isDelisted") == [("A", None, True), ("B", None, False), ("C", "S", True), ("D", None, None)]
    industries = resolve_industries(normalize.industries(feed))
    assert rows(industries, "industry_sector", "disposition") == [("", "inserted"), ("S", "inserted"), (None, "skipped")]
    sics = resolve_sic(normalize.sic_industries(feed))
    assert rows(sics, "sic_id", "sic_sector", "sic_industry", "disposition") == [(1, None, "", "skipped"), (2, "", "", "inserted"), (3, "T", "I", "inserted")]
    folder = land("markets", "m.json", [{"region": "r1", "market_type": "E", "local_open": None, "local_close": "16:00"}, {"region": "r2", "market_type": "E", "local_open": "9:30", "local_close": "16:00"}])
    regions = resolve_regions(normalize.regions(landing.read_markets(spark, folder)))
    assert rows(regions, "region_name", "disposition") == [("r1", "skipped"), ("r2", "inserted")]


def test_lists_follow_one_another_whole(spark, rows):
    lists = [spark.createDataFrame([(i, f"{n}{i}") for i in range(size)], "pos int, name string") for n, size in (("a", 3), ("b", 2), ("c", 2))]
    assert rows(normalize.join_lists(lists, None)) == [(0, "a0"), (1, "a1"), (2, "a2"), (3, "b0"), (4, "b1"), (5, "c0"), (6, "c1")]
    assert rows(normalize.join_lists(lists, 3), "name") == [("a0",), ("b0",), ("c0",)]


def test_larger_feeds_land_in_more_files_in_order(spark, tmp_path):
    feed = spark.range(1000).select((999 - F.col("id")).alias("id"))
    for rows, files in ((100, 10), (1000, 4)):
        folder = f"{tmp_path}/{files}"
        assert land_lines(feed, ["id"], ["id"], folder, rows) == files
        landed = {f.name: [json.loads(line)["id"] for line in f.read_text().splitlines()] for f in Path(folder).glob("*.json")}
        assert [k for name in sorted(landed) for k in landed[name]] == list(range(1000))
        assert len(landed) == files and max(map(len, landed.values())) < 2 * rows
