"""Tables that change by one rename: the fact by day, and versions of small tables."""

import pytest
from pyspark.sql import functions as F

from quotemart.operators.quality import ConstraintError
from quotemart.plans.jobs import load_feeds
from quotemart.schemas import FACT, SCHEMAS, SOURCE_TABLES
from quotemart.sinks import daytable
from quotemart.sinks import fact as fact_sink
from quotemart.sinks.daytable import DayTable
from quotemart.sinks.store import Store
from quotemart.sources import files


def facts(spark, pairs, volume=1, **keys):
    """Fact rows of (day, company key) pairs."""
    rows = spark.createDataFrame(pairs, "date_key int, company_key int")
    return rows.select(
        "date_key",
        "company_key",
        *[F.lit(keys.get(k, 1)).cast("int").alias(k) for k in ("industry_key", "exchange_key")],
        *[F.lit(1).cast("decimal(18,4)").alias(c) for c in ("open_price", "high_price", "low_price", "close_price")],
        F.lit(volume).cast("bigint").alias("volume"),
        F.lit(0).cast("decimal(18,4)").alias("price_change"),
        F.lit("unchanged").alias("price_trend"),
    ).select(*SCHEMAS[FACT].names)


@pytest.fixture
def parents(spark):
    one = {k: spark.createDataFrame([(1,)], f"{k} int") for k in ("industry_key", "exchange_key")}
    days = spark.createDataFrame([(d,) for d in (1, 2, 3, 4)], "date_key int")
    companies = spark.createDataFrame([(k,) for k in (1, 2, 3)], "company_key int")
    return {"date_key": (days, "date_key"), "company_key": (companies, "company_key")} | {k: (v, k) for k, v in one.items()}


def held(rows, spark, path):
    return rows(fact_sink.read_fact(spark, path), "date_key", "company_key", "volume")


def test_days_are_replaced_and_emptied_together(spark, folder, rows, parents):
    path = folder("fact")
    first = fact_sink.write_days(facts(spark, [(1, 1), (1, 2), (2, 1), (3, 1)]), path, {1: 2, 2: 1, 3: 1}, parents)
    assert first == {"rows": 4, "days": 3, "emptied": 0, "dropped": 0}
    second = fact_sink.write_days(facts(spark, [(2, 3), (4, 1), (None, 1)], 7), path, {2: 1, 3: 5, 4: 1}, parents)
    assert second == {"rows": 2, "days": 2, "emptied": 1, "dropped": 1}
    assert held(rows, spark, path) == [(1, 1, 1), (1, 2, 1), (2, 3, 7), (4, 1, 7)]
    assert rows(fact_sink.read_fact(spark, path, [2, 9]), "company_key") == [(3,)]
    plan = fact_sink.read_fact(spark, path, [1])._jdf.queryExecution().executedPlan().toString()
    assert "date_key" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "date_key=2" not in plan


@pytest.mark.parametrize("bad,message", [([(2, 99)], "foreign key"), ([(2, None)], "not null"), ([(9, 1)], "date_key")])
def test_a_broken_key_changes_no_day(spark, folder, rows, parents, bad, message):
    path = folder("fact")
    fact_sink.write_days(facts(spark, [(1, 1), (2, 1)]), path, {1: 1, 2: 1}, parents)
    before = held(rows, spark, path), files.names(spark, f"{path}/loads")
    with pytest.raises(ConstraintError, match=message):
        fact_sink.write_days(facts(spark, [(1, 3), *bad]), path, {1: 1, 2: 1, 9: 1}, parents)
    assert (held(rows, spark, path), files.names(spark, f"{path}/loads")) == before


def test_a_failure_before_the_rename_changes_no_day(spark, folder, rows, parents, monkeypatch):
    path = folder("fact")
    fact_sink.write_days(facts(spark, [(1, 1), (2, 1)]), path, {1: 1, 2: 1}, parents)
    before = held(rows, spark, path)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(daytable.files, "commit", lost)
        with pytest.raises(OSError, match="lost"):
            fact_sink.write_days(facts(spark, [(1, 2), (2, 2)]), path, {1: 1, 2: 1}, parents)
    assert held(rows, spark, path) == before
    fact_sink.write_days(facts(spark, [(1, 2), (2, 2)]), path, {1: 1, 2: 1}, parents)
    assert [r[1] for r in held(rows, spark, path)] == [2, 2]


def test_two_loads_of_days_at_once_both_count(spark, folder, rows, parents, monkeypatch):
    path = folder("fact")
    fact_sink.write_days(facts(spark, [(1, 1), (2, 1), (3, 1)]), path, {1: 1, 2: 1, 3: 1}, parents)
    real, tries = files.commit, []

    def late(session, source, target):
        if not tries:
            tries.append(target)
            fact_sink.write_days(facts(spark, [(2, 2)]), path, {2: 1, 3: 1}, parents)
        return real(session, source, target)

    monkeypatch.setattr(daytable.files, "commit", late)
    fact_sink.write_days(facts(spark, [(1, 3)]), path, {1: 1}, parents)
    assert held(rows, spark, path) == [(1, 3, 1), (2, 2, 1)]


def test_old_days_go_with_the_versions_that_name_them(spark, folder, rows):
    table = DayTable(spark, folder("days"), "day", spark.createDataFrame([], "day int, x int").schema)
    assert table.read().count() == 0 and not table.exists()
    for k in range(daytable.KEPT + 3):
        staged = table.stage(spark.createDataFrame([(1, k), (10 + k, k)], "day int, x int"))
        assert table.publish(staged, [], f"run {k}") == []
    n = daytable.KEPT + 3
    assert rows(table.read()) == [(1, n - 1)] + [(10 + k, k) for k in range(n)]
    assert rows(table.read(label=f"run {n - 2}")) == [(1, n - 2)] + [(10 + k, k) for k in range(n - 1)]
    assert len(files.names(spark, f"{table.path}/pointers")) == daytable.KEPT
    kept = [load for load in files.names(spark, f"{table.path}/loads") if "day=1" in files.names(spark, f"{table.path}/loads/{load}")]
    assert len(kept) == daytable.KEPT
    with pytest.raises(ValueError, match="run 0"):
        table.read(label="run 0")
    table.clear()
    assert table.read().count() == 0


def test_two_loads_of_a_table_at_once_give_no_key_twice(spark, folder, rows):
    store = Store(spark, folder("source"))
    store.init(SOURCE_TABLES)
    schema = "pos int, region string, market_type string, local_open string, local_close string, primary_exchanges string"

    def markets(*names):
        return spark.createDataFrame([(k, n, "E", "09:30", "16:00", f"X{n}") for k, n in enumerate(names)], schema)

    other, real, nested = Store(spark, store.folder), store._attempt, []

    def late(name, df, number):
        if name == "regions" and not nested:
            nested.append(number)
            load_feeds(spark, None, markets("b", "c"), other)
        return real(name, df, number)

    store._attempt = late
    load_feeds(spark, None, markets("a", "b"), store)
    found = rows(store.read("regions"), "region_name", "region_id")
    assert [n for n, _ in found] == ["a", "b", "c"] and sorted(i for _, i in found) == [1, 2, 3]
    exchanges = rows(store.read("exchanges"), "exchange_name", "exchange_region_id")
    assert exchanges == [(f"X{n}", i) for n, i in found]
    assert store.rows("regions") == 3 and store.rows("nothing") is None


def test_companies_of_two_loads_at_once_are_one_row_each(spark, folder, rows):
    from tests.test_jobs import COMPANIES, MARKETS

    from quotemart.sources.landing import COMPANY_FIELDS, SIC_FIELDS

    store = Store(spark, folder("source"))
    load_feeds(spark, None, spark.createDataFrame(
        [(k, m["region"], m["market_type"], m["local_open"], m["local_close"], m["primary_exchanges"]) for k, m in enumerate(MARKETS["markets"])],
        "pos int, region string, market_type string, local_open string, local_close string, primary_exchanges string",
    ), store)
    names = [*COMPANY_FIELDS, *SIC_FIELDS]
    feed = spark.createDataFrame(
        [(k, *(None if c.get(n) is None else str(c[n]).lower() if n == "isDelisted" else c[n] for n in names), c.get("sector") or "") for k, c in enumerate(COMPANIES)],
        "pos int, " + ", ".join(f"{n} string" for n in names) + ", listed_sector string",
    ).withColumn("isDelisted", F.col("isDelisted").cast("boolean"))
    real, nested = store._attempt, []

    def late(name, df, number):
        if name == "companies" and not nested:
            nested.append(number)
            load_feeds(spark, feed.withColumn("location", F.lit("Other")), None, Store(spark, store.folder))
        return real(name, df, number)

    store._attempt = late
    counts = {(r.entity, r.disposition): r["rows"] for r in load_feeds(spark, feed, None, store).collect()}
    companies = rows(store.read("companies"), "company_ticker", "company_is_delisted", "company_location")
    assert len(companies) == len({c[:2] for c in companies}) == 5 and counts["companies", "updated"] == 5


def test_known_sizes_start_no_job(spark, folder):
    from quotemart.operators.resolve import resolve_companies

    store = Store(spark, folder("source"))
    store.init(SOURCE_TABLES)
    names = "name cik ticker category currency location exchange industry sector sic".split()
    feed = spark.createDataFrame([], "pos int, isDelisted boolean, " + ", ".join(f"{n} string" for n in names))
    tables = ["exchanges", "industries", "sicindustries", "companies"]
    opened = [store.read(t) for t in tables]
    spark.sparkContext.setJobGroup("planning", "no job")
    try:
        rows = resolve_companies(feed, *opened, sizes={t: store.rows(t) for t in tables})
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("planning")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert plan.count("strategy=broadcast") >= 4
