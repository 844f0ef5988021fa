"""Every registered query against its SQL, and the shape of its plan."""

from __future__ import annotations

import inspect

import duckdb
import pytest

from checks import oracle, registry
from checks.compare import TABLES, canonical

QUERIES, SQL = registry.queries(), oracle.statements()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("NestedLoop", "CartesianProduct", "PythonUDF", "ArrowEval", "MapInPandas", "SinglePartition",
                     "Expand"):
        # A scalar subquery (newest month) gathers one partial maximum per task.
        if unwanted == "SinglePartition" and "route" in name:
            continue
        assert unwanted not in plan, f"{name} plans {unwanted}"
    rows = [tuple(r) for r in df.collect()]
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    want = cursor.fetchall()
    assert want, "no rows to compare"
    assert canonical(rows, df.columns) == canonical(want, names)


@pytest.mark.parametrize("name,exchanges", [("inv_bill_brand_full", 3), ("inv_bill_brand_text", 4)])
def test_bills_shuffle_the_lines_once(spark, sf_dir, name, exchanges):
    """Lines to bills, bills to keys (for text pairs with a step between), and the customers of the join."""
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == exchanges


def scan_filters(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name,column", [
    ("invoice_slice", "l_shipdate"), ("visit_list_slice", "o_orderdate"), ("actual_visit_slice", "l_shipdate"),
    ("actual_visit_full", "l_shipdate"), ("asset_plan_slice", "o_orderdate"), ("visit_call", "o_orderdate"),
    ("visit_call", "l_shipdate"),
])
def test_windows_reach_the_scan(spark, sf_dir, name, column):
    plan = scan_filters(QUERIES[name](spark, sf_dir))
    assert f"GreaterThanOrEqual({column}" in plan


def test_no_driver_data_in_jobs():
    from martloom.operators import geo, joins, recon, replace
    from martloom.plans import assets, common, daily, dims, facts, mirror, outlets, scorecard, visits, volume
    for module in (geo, joins, recon, replace, assets, common, daily, dims, facts, mirror, outlets, scorecard, visits,
                   volume):
        source = inspect.getsource(module)
        for call in (".collect(", ".toPandas(", "localCheckpoint", "crossJoin", ".udf("):
            assert call not in source, f"{module.__name__} uses {call}"


def test_no_job_forces_a_broadcast():
    """Spark sizes every broadcast from statistics."""
    from pathlib import Path

    import martloom
    for path in Path(martloom.__file__).parent.rglob("*.py"):
        if "llm" not in path.parts:
            assert "broadcast(" not in path.read_text(encoding="utf-8"), path


@pytest.mark.parametrize("name", ["active_outlet_full", "scorecard", "inv_vol_by_brand"])
def test_building_a_query_reads_schemas_only(spark, sf_dir, name):
    """At most one job per table, for its footer."""
    spark.sparkContext.setJobGroup(f"build {name}", "")
    QUERIES[name](spark, sf_dir)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"build {name}")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= len(TABLES)
