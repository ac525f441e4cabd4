"""Every registered query against its SQL on the smallest sample tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import compare
from tickhouse.catalogue import registry
from tickhouse.catalogue.market import tables
from tickhouse.operators.bars import aggregate_bars

SF = os.environ.get("TICKHOUSE_TEST_SF", "/root/testdata/sf0.001")
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()

pytestmark = pytest.mark.skipif(not glob.glob(f"{SF}/*.parquet"), reason="no sample tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return con


def test_each_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLES[name])
    problem = compare(df.columns, [tuple(r) for r in df.collect()],
                      [d[0] for d in cur.description], cur.fetchall())
    assert not problem, problem


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["market_fact", "fx_range_join_bucketed", "tick_asof",
                                  "quote_durations", "liquidity_ranking", "merge_upsert"])
def test_no_nested_loop_or_cartesian_plan(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("name", ["fx_range_join", "tick_asof"])
def test_the_asof_plan_reads_whole_rows_of_the_tape_once(spark, name):
    """Besides, only the columns that keys and times are made of, for the occupied chunks
    which the plan names twice."""
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "lineitem" in line]
    assert 2 <= len(scans) <= 3
    assert sum("l_extendedprice" in line for line in scans) == 1


def test_trades_that_come_once_are_not_shuffled(spark):
    plan = QUERIES["dedup_trades"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Window" not in plan


def test_candles_need_no_sort(spark):
    tape = tables(spark, SF).tape()
    plan = aggregate_bars(tape, 86_400)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Sort [" not in plan
