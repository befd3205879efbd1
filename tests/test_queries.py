"""Every registered query against its SQL on the smallest tables, and what the plans may contain."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from tidewire.plans import catalog, streams

SF = "/root/testdata/sf0.001"
TABLES = ["events"]
QUERIES = {**catalog.BATCH, **streams.STREAMS}
SQL = {name: text for name, text in contract.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int) or type(value).__name__ == "Decimal":
        return float(value)
    return value


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = ordered([tuple(plain(r[c]) for c in columns) for r in df.collect()])
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = ordered([tuple(plain(row[names.index(c)]) for c in columns) for row in result.fetchall()])
    assert got == want and got


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["q1_consecutive_diff", "q2_time_window", "count_window_avg", "state_as_of_tick", "wireless_edges_mutual"])
def test_plans_stay_inside_the_engine(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert unwanted not in plan


def test_scans_read_only_needed_columns(spark):
    plan = QUERIES["count_window_avg"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert scans and all("props" not in line and "user_id" not in line for line in scans)
