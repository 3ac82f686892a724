"""Plans that must hold at any size."""

import pytest

from quotemart.checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
STAGED = {"parquet_roundtrip", "json_roundtrip", "retention_latest", "source_load", "warehouse_load"}


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - STAGED))
def test_no_row_pairs_and_no_python(spark, name):
    plan = physical(QUERIES[name](spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert bad not in plan


def test_fact_shuffles_bars_for_dedup_only_and_joins_once(spark):
    lines = physical(QUERIES["fact_stock_daily"](spark, FOLDER)).splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line and "l_orderkey" in line)
    depth = [len(line) - len(line.lstrip(" :+-*")) for line in lines]
    path, at = [], depth[scan]
    for i in range(scan - 1, -1, -1):
        if depth[i] < at:
            path.append(lines[i])
            at = depth[i]
    assert sum("Exchange" in line for line in path) == 2  # keep-first, then distinct
    assert sum("Join" in line for line in path) == 1
    assert sum("BroadcastHashJoin" in line for line in path) == 1


def test_scans_read_only_what_they_need(spark):
    plan = physical(QUERIES["dim_date"](spark, FOLDER))
    assert "ReadSchema: struct<l_shipdate:timestamp_ntz>" in plan
    plan = physical(QUERIES["retention_latest"](spark, FOLDER))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,year:int>" in plan
