import datetime as dt
import io
from contextlib import redirect_stdout

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quotemart.operators import quality
from quotemart.operators.days import drop_null_keys, replace_days
from quotemart.operators.dedup import first_rows, keep_first, mark_first
from quotemart.operators.history import append_current, company_key, expire_and_insert
from quotemart.operators.keys import assign_keys
from quotemart.operators.lookup import has_at_most, lookup_side
from quotemart.operators.resolve import (
    accepted,
    disposition_counts,
    resolve_companies,
    resolve_exchanges,
    resolve_regions,
    resolve_sic,
)
from quotemart.operators.upsert import insert_absent, merge_companies, upsert, upsert_sic
from quotemart.schemas import SCHEMAS
from quotemart.session import scratch_dir, shuffle_partitions
from quotemart.sources.snapshots import only_latest

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def plan_of(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_keep_first_cuts_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("pos"))
    plan = plan_of(keep_first(df, ["k"], [F.col("pos")]))
    partial, exchange = plan.index("row_number(), 1, Partial"), plan.index("Exchange hashpartitioning")
    assert exchange < partial  # printed from the result down: the partial cut feeds the exchange


@FEW
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3)), max_size=30))
def test_keep_first_against_a_dict(spark, pairs):
    df = spark.createDataFrame([(k, n, i) for i, (k, n) in enumerate(pairs)], "k string, n int, pos int")
    expected = {}
    for i, pair in enumerate(pairs):
        expected.setdefault(pair, i)
    kept = keep_first(df, ["k", "n"], [F.col("pos")])
    assert {(r["k"], r["n"]): r["pos"] for r in kept.collect()} == expected


def test_mark_first_with_a_hot_key(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("pos"))
    marked = mark_first(df, ["k"], "pos", "first", F.col("pos") > 0)
    assert marked.count() == 3000
    firsts = {r["pos"] for r in marked.where("first").collect()}
    assert firsts == {3} | {i for i in range(1, 3000) if i % 3}


def test_keys_are_dense_repeatable_and_follow_the_existing_ones(spark):
    names = spark.range(5000).select(F.concat(F.lit("n"), "id").alias("name"))
    old = spark.createDataFrame([(7,), (41,)], "id int")
    once, again = (
        {r["name"]: r["id"] for r in assign_keys(df, [F.col("name")], "id", old).collect()}
        for df in (names, names.repartition(13))
    )
    assert once == again
    assert sorted(once.values()) == list(range(42, 5042))


def test_keys_start_at_one(spark):
    names = spark.createDataFrame([("a", None), ("a", "x"), (None, None)], "p string, q string")
    empty = spark.createDataFrame([], "id int")
    for existing in (None, empty):
        keyed = assign_keys(names, [F.col("p"), F.col("q")], "id", existing)
        assert sorted(r["id"] for r in keyed.collect()) == [1, 2, 3]


class Session:
    """As much of a session as the scratch folder asks for."""

    def __init__(self, master, **settings):
        self.conf, self.sparkContext, self.master = settings, self, master


def test_scratch_folder_is_the_shared_one_where_the_session_names_it():
    shared = Session("yarn", **{"spark.checkpoint.dir": "hdfs://shared/place/"})
    assert scratch_dir(shared, "x").startswith("hdfs://shared/place/x-")
    assert scratch_dir(shared, "x") != scratch_dir(shared, "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session("yarn"), "x")
    assert "quotemart-" in scratch_dir(Session("local[2]"), "x")


def test_shuffle_partitions_grow_with_the_input():
    assert shuffle_partitions(10**9) == 200
    assert shuffle_partitions(100 * 10**12) == 372_530


def test_lookup_side_is_broadcast_only_below_the_bound(spark):
    small, big = spark.range(10).withColumnRenamed("id", "k"), spark.range(1000).select((F.col("id") % 10).alias("k"))
    assert has_at_most(small, 10) and not has_at_most(small, 9)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan_of(big.join(lookup_side(small, rows=10), "k"))
        assert "SortMergeJoin" in plan_of(big.join(lookup_side(small, rows=9), "k"))
        assert "SortMergeJoin" in plan_of(big.join(lookup_side(small, bound=big, rows=10), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def regions(spark):
    return spark.createDataFrame(
        [(1, "US", "Equity", "09:30:00", "16:00:00", dt.datetime(2020, 1, 1)), (5, "UK", "Equity", "08:00:00", "16:30:00", dt.datetime(2020, 1, 1))],
        SCHEMAS["regions"],
    )


def test_upsert_keeps_ids_replaces_with_null_and_stamps_changes_only(spark, rows, regions):
    columns = ["region_market_type", "region_local_open", "region_local_close"]
    new = spark.createDataFrame(
        [("US", None, "09:30:00", "16:00:00"), ("UK", "Equity", "08:00:00", "16:30:00"), ("JP", "Equity", "09:00:00", "15:00:00")],
        "region_name string, region_market_type string, region_local_open string, region_local_close string",
    )
    now = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
    stamp = "region_update_time_stamp"
    once = upsert(regions, new, ["region_name"], columns, "region_id", stamp, now)
    found = rows(once, "region_id", "region_name", "region_market_type", stamp)
    assert found == [
        (1, "US", None, dt.datetime(2024, 1, 1)),
        (5, "UK", "Equity", dt.datetime(2020, 1, 1)),
        (6, "JP", "Equity", dt.datetime(2024, 1, 1)),
    ]
    later = F.lit(dt.datetime(2025, 1, 1)).cast("timestamp_ntz")
    assert rows(upsert(once, new, ["region_name"], columns, "region_id", stamp, later)) == rows(once)


def test_insert_absent_changes_nothing_on_a_second_run(spark, rows):
    old = spark.createDataFrame([(3, "Banks", "Money")], "industry_id int, industry_name string, industry_sector string")
    new = spark.createDataFrame([("Banks", "Money"), ("Banks", "Gas")], "industry_name string, industry_sector string")
    on = ["industry_name", "industry_sector"]
    once = insert_absent(old, new, on, "industry_id")
    assert rows(once) == [(3, "Banks", "Money"), (4, "Banks", "Gas")]
    assert rows(insert_absent(once, new, on, "industry_id")) == rows(once)


def test_sic_pair_clash_adds_no_row(spark, rows):
    old = spark.createDataFrame([(1, "I1", "S"), (2, "I2", "S")], "sic_id int, sic_industry string, sic_sector string")
    new = spark.createDataFrame(
        [(0, 3, "I1", "S"), (1, 2, "I1", "S"), (2, 1, "I9", "S"), (3, 4, "I4", "S"), (4, 5, "I4", "S")],
        "pos int, sic_id int, sic_industry string, sic_sector string",
    )
    once = upsert_sic(old, new)
    # Codes 2 and 3 change nothing because code 1 held their pair; of codes 4 and 5 the first counts.
    assert rows(once) == [(1, "I9", "S"), (2, "I2", "S"), (4, "I4", "S")]


def test_sic_new_code_ahead_of_a_known_one_takes_the_pair(spark, rows):
    old = spark.createDataFrame([(2, "P2", "S")], "sic_id int, sic_industry string, sic_sector string")
    batch = "pos int, sic_id int, sic_industry string, sic_sector string"
    assert rows(upsert_sic(old, spark.createDataFrame([(0, 1, "P", "S"), (1, 2, "P", "S")], batch))) == [(1, "P", "S"), (2, "P2", "S")]
    assert rows(upsert_sic(old, spark.createDataFrame([(0, 2, "P", "S"), (1, 1, "P", "S")], batch))) == [(2, "P", "S")]


def test_resolve_exchanges(spark, rows, regions):
    feed = spark.createDataFrame(
        [(0, "NYSE", "US"), (1, "", "US"), (2, "LSE", "uk"), (3, "X" * 101, "UK"), (4, None, "UK")],
        "pos int, name string, region string",
    )
    resolved = resolve_exchanges(feed, regions)
    assert rows(resolved, "pos", "exchange_region_id", "disposition", "reason") == [
        (0, 1, "inserted", None),
        (1, 1, "skipped", "no name"),
        (2, None, "error", "unknown region"),
        (3, 5, "error", "too long"),
        (4, 5, "skipped", "no name"),
    ]
    assert rows(disposition_counts("exchanges", resolved)) == [
        ("exchanges", "error", 2),
        ("exchanges", "inserted", 1),
        ("exchanges", "skipped", 2),
    ]


def test_resolve_regions_and_sic(spark, rows):
    feed = spark.createDataFrame(
        [(0, "US", "Equity", "9:30", "16:00"), (1, "UK", "Equity", "", "16:00"), (2, "R" * 51, "Equity", "9:30", "16:00")],
        "pos int, region string, market_type string, local_open string, local_close string",
    )
    assert rows(resolve_regions(feed), "pos", "region_local_open", "reason") == [
        (0, "09:30:00", None),
        (1, None, "bad time"),
        (2, "09:30:00", "too long"),
    ]
    codes = spark.createDataFrame(
        [(0, "7372", "I", "S"), (1, "abc", "I", "S"), (2, "", "I", "S"), (3, "1", None, "S")],
        "pos int, sic string, sicIndustry string, sicSector string",
    )
    assert rows(resolve_sic(codes), "pos", "sic_id", "disposition", "reason") == [
        (0, 7372, "inserted", None),
        (1, None, "skipped", "bad number"),
        (3, 1, "skipped", "missing value"),
    ]


COMPANY_FEED = (
    "pos int, name string, ticker string, cik string, exchange string, isDelisted boolean, category string, "
    "sector string, industry string, sic string, currency string, location string"
)


@pytest.fixture
def company_tables(spark):
    exchanges = spark.createDataFrame([(1, 1, "NYSE", None)], SCHEMAS["exchanges"])
    industries = spark.createDataFrame([(4, "Banks", "Money", None)], SCHEMAS["industries"])
    sics = spark.createDataFrame([(7372, "I", "S", None)], SCHEMAS["sicindustries"])
    companies = spark.createDataFrame(
        [(9, 1, None, None, "Old", "1", "K", False, "Cat", "USD", "NY", None)], SCHEMAS["companies"]
    )
    return exchanges, industries, sics, companies


def feed_row(pos, ticker="N", name="n", cik="1", exchange="NYSE", delisted=None, category=None, sector="Money", industry="Banks", sic="7372"):
    return (pos, name, ticker, cik, exchange, delisted, category, sector, industry, sic, "USD", f"loc{pos}")


def test_company_dispositions(spark, rows, company_tables):
    feed = spark.createDataFrame(
        [
            feed_row(0, ticker=""),
            feed_row(1, name=None),
            feed_row(2, cik=""),
            feed_row(3, exchange="TSE"),
            feed_row(4, exchange=""),
            feed_row(5, exchange=None),
            feed_row(6, sector=None, sic="abc"),
            feed_row(7, sic="12.0"),
            feed_row(8, ticker="K"),
            feed_row(9, ticker="K", sic=None),
            feed_row(10, ticker="K", delisted=True, sic="1"),
            feed_row(11, ticker="TOOLONGTICKER"),
        ],
        COMPANY_FEED,
    )
    resolved = resolve_companies(feed, *company_tables)
    assert rows(resolved, "pos", "company_industry_id", "company_sic_id", "known", "disposition") == sorted(
        [
            (0, 4, 7372, False, "skipped"),
            (1, 4, 7372, False, "skipped"),
            (2, 4, 7372, False, "skipped"),
            (3, 4, 7372, False, "error"),
            (4, 4, 7372, False, "skipped"),
            (5, 4, 7372, False, "skipped"),
            (6, None, None, False, "inserted"),
            (7, 4, None, False, "skipped"),
            (8, 4, 7372, True, "updated"),
            (9, 4, None, True, "updated"),
            (10, 4, None, False, "inserted"),
            (11, 4, 7372, False, "error"),
        ],
        key=repr,
    )


def test_company_merge_last_known_first_new_and_rejects_never_hide(spark, rows, company_tables):
    feed = spark.createDataFrame(
        [
            feed_row(0, ticker="N", exchange="TSE"),
            feed_row(1, ticker="N"),
            feed_row(2, ticker="N"),
            feed_row(3, ticker="K", category="X"),
            feed_row(4, ticker="K", category=None),
            feed_row(5, ticker="K", category="Y", exchange="TSE"),
        ],
        COMPANY_FEED,
    )
    old = company_tables[3]
    once = merge_companies(old, resolve_companies(feed, *company_tables))
    found = rows(once, "company_id", "company_ticker", "company_category", "company_location")
    assert found == [(10, "N", None, "loc1"), (9, "K", None, "loc4")]
    again = merge_companies(once, resolve_companies(feed, *company_tables[:3], once))
    assert rows(again, "company_id", "company_ticker") == rows(once, "company_id", "company_ticker")
    # The first valid N and both valid K; the second N is a repetition.
    assert rows(accepted(resolve_companies(feed, *company_tables)), "pos") == [(1,), (3,), (4,)]


DIM = "company_key int, company_ticker string, company_name string, is_current boolean"


def test_history_keeps_expires_and_inserts(spark, rows):
    dim = spark.createDataFrame(
        [(1, "AA", "a", True), (2, "BB", "b", True), (3, "CC", None, True), (4, "AA", "a0", False)], DIM
    )
    new = spark.createDataFrame([("AA", "a"), ("BB", "b2"), ("CC", None), ("DD", "d")], "company_ticker string, company_name string")
    once = expire_and_insert(dim, new, company_key, "company_key")
    assert rows(once.where("company_key <= 4")) == [
        (1, "AA", "a", True),
        (2, "BB", "b", False),
        (3, "CC", None, True),
        (4, "AA", "a0", False),
    ]
    assert rows(once.where("company_key > 4"), "company_ticker", "company_name", "is_current") == [
        ("BB", "b2", True),
        ("DD", "d", True),
    ]
    assert rows(expire_and_insert(once, new, company_key, "company_key")) == rows(once)
    assert once.where("is_current").groupBy(F.lower("company_ticker")).count().where("count > 1").count() == 0


def test_append_doubles_on_every_run(spark):
    dim = spark.createDataFrame([], DIM)
    new = spark.createDataFrame([("AA", "a"), ("BB", "b")], "company_ticker string, company_name string")
    once = append_current(dim, new, company_key, "company_key")
    twice = append_current(once, new, company_key, "company_key")
    assert (once.count(), twice.count(), twice.where("is_current").count()) == (2, 4, 4)
    assert sorted(r["company_key"] for r in twice.collect()) == [1, 2, 3, 4]


def test_replace_days_empties_a_day(spark, rows):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "date_key int, v string")
    fresh = spark.createDataFrame([(1, "x")], "date_key int, v string")
    touched = spark.createDataFrame([(1,), (2,)], "date_key int")
    once = replace_days(old, fresh, touched)
    assert rows(once) == [(1, "x"), (3, "c")]
    assert rows(replace_days(once, fresh, touched)) == rows(once)


def test_null_keys_go(spark):
    columns = ["date_key", "company_key", "industry_key", "exchange_key"]
    full = [1, 2, 3, 4]
    holes = [[None if i == j else v for i, v in enumerate(full)] for j in range(4)]
    df = spark.createDataFrame([full, *holes], ", ".join(f"{c} int" for c in columns))
    assert drop_null_keys(df).count() == 1


def test_quality(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "bbb"), (None, None), (None, "c")], "id int, name string")
    parent = spark.createDataFrame([(2,)], "id int")
    checks = [
        quality.not_null(df, "t", ["id", "name"]),
        quality.unique(df, "t", ["id"]),
        quality.unique(df, "t", ["id", "name"]),
        quality.foreign_keys(df, "t", {"id": (parent, "id")}),
        quality.max_length(df, "t", {"name": 2}),
    ]
    assert rows(quality.report(checks)) == sorted(
        [
            ("t", "not null", "id", 2),
            ("t", "not null", "name", 1),
            ("t", "unique", "id", 1),
            ("t", "unique", "id, name", 0),
            ("t", "foreign key", "id", 2),
            ("t", "length", "name", 1),
        ],
        key=repr,
    )
    with pytest.raises(quality.ConstraintError, match="foreign key"):
        quality.require(checks)
    quality.require(checks[2:3])


def test_foreign_keys_of_several_columns(spark, rows):
    child = spark.createDataFrame([(1, 5), (1, None), (2, 6), (3, 5)], "a int, b int")
    one, two = spark.createDataFrame([(1,), (2,), (3,)], "x int"), spark.createDataFrame([(5,)], "y int")
    found = quality.foreign_keys(child, "t", {"a": (one, "x"), "b": (two, "y")})
    assert rows(found, "columns", "violations") == [("a", 0), ("b", 1)]


def test_first_rows_beyond_the_planner_bound(spark):
    df = spark.range(20_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 7).alias("k"), F.col("id").alias("pos")
    )
    got = first_rows(df, ["k"], [F.col("pos").desc()], 1500)
    assert "row_number(), 1500" not in plan_of(got)
    expected = {}
    for r in sorted(df.collect(), key=lambda r: -r["pos"]):
        expected.setdefault(r["k"], []).append(r["pos"])
    found = {}
    for r in got.collect():
        found.setdefault(r["k"], []).append(r["pos"])
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v[:1500]) for k, v in expected.items()}


def test_only_latest(spark, rows):
    df = spark.createDataFrame([("2024_01_02", 1), ("2024_01_10", 2), ("2023_12_31", 3)], "token string, v int")
    assert rows(only_latest(df, "token"), "v") == [(2,)]
