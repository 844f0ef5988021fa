"""The scorecard joins and reads the lines once, and its views over the packed lines are the plain ones."""

from __future__ import annotations

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from checks.registry import queries
from checks.roles import TEST_RULES, LinesOnce, Roles
from martloom.plans import visits, volume
from martloom.plans.common import outlet_customers
from tests import traps

TABLES = ["customer", "lineitem", "nation", "orders", "part", "supplier"]


@pytest.mark.parametrize("name", ["scorecard", "scorecard_parity"])
def test_lines_are_read_once(spark, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet \[[^\]]*l_orderkey", final)) == 1
    assert final.count("ReusedExchange") >= 5


@pytest.fixture(scope="module")
def odd_dir(spark, sf_dir, tmp_path_factory):
    """A few lines with customers and parts listed twice or not at all, and orders without a customer or a day."""
    out = str(tmp_path_factory.mktemp("odd"))
    t = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in TABLES}
    t["orders"] = t["orders"].filter("o_orderkey < 300").withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 17 != 0, F.col("o_custkey"))).withColumn(
        "o_orderdate", F.when(F.col("o_orderkey") % 19 != 0, F.col("o_orderdate")))
    t["lineitem"] = t["lineitem"].filter("l_orderkey < 300").withColumn(
        "l_partkey", F.when(F.col("l_linenumber") != 3, F.col("l_partkey")))
    t["customer"] = t["customer"].filter("c_custkey % 5 != 0").unionByName(
        t["customer"].filter("c_custkey % 7 = 1").withColumn("c_mktsegment", F.lit(None).cast("string")))
    t["part"] = t["part"].filter("p_partkey % 5 != 0").unionByName(
        t["part"].filter("p_partkey % 7 = 1").withColumn("p_size", F.col("p_size") + 1))
    for name, df in t.items():
        df.write.parquet(f"{out}/{name}.parquet")
    return out


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def both(spark, odd_dir, view, *columns):
    found = [rows(view(kind(spark, odd_dir)).selectExpr(*columns)) for kind in (Roles, LinesOnce)]
    assert found[0]
    return found


@pytest.mark.parametrize("name", ["stage_invoice", "invoice"])
def test_packed_lines_are_the_lines(spark, odd_dir, name):
    view = lambda r: getattr(r, name)()
    days = ("BillingDate", "ETLLoadData")
    columns = [f"CAST({c} AS DATE) AS {c}" if c in days else c for c in view(Roles(spark, odd_dir)).columns]
    plain, packed = both(spark, odd_dir, view, *columns)
    assert plain == packed


def test_packed_plan_is_the_plan(spark, odd_dir):
    plain, packed = both(spark, odd_dir, lambda r: r.plan(), "YM", "Branch", "Route", "Customer")
    assert plain == packed


def test_packed_visits_are_the_visits(spark, odd_dir):
    plain, packed = Roles(spark, odd_dir), LinesOnce(spark, odd_dir)
    want = visits.visit_totals(plain.planned_visits(), plain.actual_visits(), plain.route(), months=None, rules=TEST_RULES)
    found = visits.marked_totals(packed.visits(), packed.route(), rules=TEST_RULES).select(want.columns)
    assert rows(found) == rows(want)


def test_described_lines_are_those_the_joins_leave(spark, odd_dir):
    plain, packed = Roles(spark, odd_dir), LinesOnce(spark, odd_dir)
    kw = dict(as_of=date(2001, 8, 1), months=None, rules=TEST_RULES)
    stores = outlet_customers(plain.customer(), plain.group(), TEST_RULES, TEST_RULES.scorecard_excluded_groups, stores_only=True)
    stores = stores.select(F.col("Customer").alias("CustomerCode")).distinct()
    for job, days in ((volume.volume_totals, "last_days"), (volume.bill_totals, None)):
        given = [{"last_days": r.last_days()} if days else {} for r in (plain, packed)]
        want = job(plain.invoice(), plain.reason(), plain.customer(), plain.material(), **kw, **given[0]).join(
            stores, "CustomerCode", "left_semi")
        found = job(packed.described("_store"), packed.reason(), packed.customer(), None, dealt=("_deal",), **kw, **given[1])
        assert rows(found.select(want.columns)) == rows(want) != []


@pytest.mark.parametrize("seed,hot", [(1, False), (2, True)])
@pytest.mark.parametrize("whole,totals", [("volume_by_brand", "volume_totals"), ("bills", "bill_totals")])
def test_totals_are_those_of_the_whole_aggregate(spark, seed, hot, whole, totals):
    t = traps.frames(spark, traps.rows(seed, hot))
    frames = t["f_invoice"], t["d_reason"], t["d_customer"], t["d_material"]
    kw = dict(as_of=date(2025, 2, 10), months=None, rules=TEST_RULES)
    found = getattr(volume, totals)(*frames, **kw)
    measures = [c for c in found.columns if c.startswith(("Sold", "Net", "Total", "NoOf"))]
    keys = [c for c in found.columns if c not in measures]
    want = getattr(volume, whole)(*frames, **kw).groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
    plain = [*keys, *[f"CAST({m} AS DOUBLE) AS {m}" for m in measures]]
    assert rows(found.selectExpr(*plain)) == rows(want.selectExpr(*plain)) != []
