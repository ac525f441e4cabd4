"""The registered queries of the subpackage against their SQL on the sample tables."""

import glob
import os

import duckdb
import pytest

import corpus_pipeline
from check import compare
from tickhouse.llm import queries, sql

SF = os.environ.get("TICKHOUSE_TEST_SF", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not glob.glob(f"{SF}/*.parquet"), reason="no sample tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return con


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    assert rows
    if name in sql.ORACLES:
        cur = con.execute(sql.ORACLES[name])
        problem = compare(df.columns, rows, [d[0] for d in cur.description], cur.fetchall())
        assert not problem, problem


def test_stage_names():
    assert len(corpus_pipeline.STAGES) == 5
