"""The lake's bars by day, from new landing files only."""

import datetime as dt
import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quotemart.plans import lake as lake_plan
from quotemart.plans.fact import first_bars
from quotemart.plans.jobs import load_warehouse
from quotemart.plans.lake import bar_table, dated, first_by_day, first_of, lake_bars, merge_bars, publish_bars, unreadable_files
from quotemart.schemas import SCHEMAS
from quotemart.sinks import daytable
from quotemart.sources import files
from quotemart.sources.landing import bar_feed, read_bars, records


def bar(ticker, day, price, hour=20):
    at = dt.datetime(2024, 1, day, hour, tzinfo=dt.timezone.utc)
    return {"T": ticker, "o": price, "h": price, "l": price, "c": price, "v": 1.0, "t": int(at.timestamp() * 1000)}


@pytest.fixture
def landed(tmp_path):
    folder = tmp_path / "bars"
    folder.mkdir()
    clock = iter(range(1_700_000_000, 1_800_000_000, 10))

    def land(name, content):
        (folder / name).write_text(content if isinstance(content, str) else json.dumps(content))
        # Files written within a second would have equal times.
        os.utime(folder / name, (t := next(clock), t))

    return str(folder), land


def full(spark, folder, rows):
    """What the full form gives: all files read, first bar of a ticker and time kept."""
    return rows(first_bars(read_bars(spark, folder)).select(*SCHEMAS["bars"].names))


def test_only_new_files_are_read_and_late_bars_count(spark, landed, folder, rows):
    where, land = landed
    lake = folder("lake")
    land("b2.json", [bar("A", 2, 2.0), bar("A", 2, 9.0), bar("B", 2, 3.0)])
    land("b3.json", [bar("A", 3, 4.0), {"T": "N", "o": 1.0}])
    assert publish_bars(spark, where, lake, "t1") == {"bars": 4, "bar_files_read": 2, "bars_unreadable": 0}
    assert rows(lake_bars(spark, lake)) == full(spark, where, rows)

    # Late bars of a held day, one hidden by an earlier file name, one that hides a held bar.
    land("b4.json", [bar("A", 2, 7.0), bar("C", 2, 5.0), bar("A", 4, 1.0)])
    land("b1.json", [bar("B", 2, 8.0)])
    land("bad.json", '[{"T": ')
    assert publish_bars(spark, where, lake, "t2") == {"bars": 6, "bar_files_read": 3, "bars_unreadable": 1}
    assert rows(lake_bars(spark, lake)) == full(spark, where, rows)
    assert rows(lake_bars(spark, lake).where("ticker = 'B'"), "open") == [(8.0,)]

    assert publish_bars(spark, where, lake, "t3") == {"bars": 6, "bar_files_read": 0, "bars_unreadable": 1}
    assert rows(unreadable_files(spark, lake)) == [("bad.json",)]
    assert lake_bars(spark, lake, "t1").count() == 4 and lake_bars(spark, lake, "t3").count() == 6


def test_a_changed_and_a_removed_file_uncover_what_they_hid(spark, landed, folder, rows):
    where, land = landed
    lake = folder("lake")
    land("a.json", [bar("A", 2, 1.0), bar("A", 3, 1.5)])
    land("b.json", [bar("A", 2, 2.0), bar("B", 4, 2.5)])
    land("c.json", [bar("C", 5, 3.0)])
    land("d.json", [bar("D", 2, 4.0)])
    publish_bars(spark, where, lake, "t1")
    land("a.json", [bar("A", 6, 9.0)])
    assert publish_bars(spark, where, lake, "t2")["bar_files_read"] == 3
    assert rows(lake_bars(spark, lake)) == full(spark, where, rows)
    assert rows(lake_bars(spark, lake, days=[20240102]).where("ticker = 'A'"), "open") == [(2.0,)]
    Path(where, "b.json").unlink()
    publish_bars(spark, where, lake, "t3")
    assert rows(lake_bars(spark, lake)) == full(spark, where, rows)
    assert 20240104 not in bar_table(spark, lake).version().days
    Path(where, "c.json").unlink()
    assert publish_bars(spark, where, lake, "t4") == {"bars": 2, "bar_files_read": 0, "bars_unreadable": 0}


def test_a_run_that_fails_before_the_ledger_is_repeated_without_harm(spark, landed, folder, rows, monkeypatch):
    where, land = landed
    lake = folder("lake")
    land("a.json", [bar("A", 2, 1.0)])
    with monkeypatch.context() as m:
        m.setattr(lake_plan.Store, "change", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            publish_bars(spark, where, lake, "t1")
    assert publish_bars(spark, where, lake, "t1")["bar_files_read"] == 1
    assert rows(lake_bars(spark, lake)) == full(spark, where, rows)


def test_a_trading_day_prunes_folders(spark, landed, folder):
    where, land = landed
    lake = folder("lake")
    for day in range(2, 8):
        land(f"f{day}.json", [bar("A", day, 1.0)])
    publish_bars(spark, where, lake, "t1")
    got = bar_table(spark, lake).read([20240103])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "trading_day" in plan.split("PartitionFilters: [")[1].split("]")[0] and got.count() == 1
    assert len(got.inputFiles()) == 1
    assert load_warehouse.__doc__ and lake_bars(spark, lake, days=[20240103]).count() == 1


def feed_of(spark, name, bars):
    return dated(bar_feed(records(spark.createDataFrame([(name, json.dumps(bars))], "file string, value string"))))


def test_files_of_a_day_do_not_grow_with_batches(spark, folder, rows):
    table = bar_table(spark, folder("lake"))
    batches = [(f"f{k:02d}", [bar(f"T{(k * 7 + i) % 9}", 2 + (k + i) % 3, float(k), hour=10 + i) for i in range(4)]) for k in range(12)]
    for name, bars in batches:
        merge_bars(table, feed_of(spark, name, bars))
        merge_bars(table, feed_of(spark, name, bars))
    whole = spark.createDataFrame([(n, json.dumps(b)) for n, b in batches], "file string, value string")
    want = rows(first_bars(bar_feed(records(whole))).select(*SCHEMAS["bars"].names))
    assert rows(table.read().select(*SCHEMAS["bars"].names)) == want
    assert len(table.read().inputFiles()) == len(table.version().days) == 3
    assert len(files.names(spark, f"{table.path}/pointers")) == daytable.KEPT
    assert len(files.names(spark, f"{table.path}/loads")) <= 3 * daytable.KEPT


def test_two_merges_of_a_day_at_once_both_count(spark, folder, rows, monkeypatch):
    table = bar_table(spark, folder("lake"))
    merge_bars(table, feed_of(spark, "a", [bar("A", 2, 1.0), bar("A", 3, 1.0)]))
    real, tries = files.commit, []

    def late(session, source, target):
        if not tries:
            tries.append(target)
            merge_bars(table, feed_of(spark, "b", [bar("B", 2, 2.0)]))
        return real(session, source, target)

    monkeypatch.setattr(daytable.files, "commit", late)
    merge_bars(table, feed_of(spark, "c", [bar("C", 2, 3.0), bar("A", 2, 9.0)]))
    assert rows(table.read(), "ticker", "open") == [("A", 1.0), ("A", 1.0), ("B", 2.0), ("C", 3.0)]
    assert not table.read().where(F.col("open") == 9.0).count()


def test_bars_meet_in_one_shuffle_before_their_days_are_written(spark, folder, rows):
    bars = feed_of(spark, "a", [bar(t, d, p) for p in (1.0, 2.0) for d in range(1, 10) for t in "ABC"])
    found = first_by_day(bars, 3, 2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert rows(found) == rows(first_of(bars)) and found.count() == 27


@pytest.mark.parametrize("most", [1, 5, 1000])
def test_repeats_that_outweigh_a_task_change_nothing(spark, folder, rows, most):
    table = bar_table(spark, folder("heavy"))
    for name, price in (("b", 2.0), ("a", 1.0)):
        merge_bars(table, feed_of(spark, name, [bar("A", 2, price)] * 40 + [bar("B", 3, price)]), rows=most)
    assert rows(table.read(), "ticker", "open", "file", "pos") == [("A", 1.0, "a", 0), ("B", 1.0, "a", 40)]
