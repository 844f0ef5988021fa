"""The scorecard's lines move without the columns that no source reads, and keys and days of any size come back from them."""

from __future__ import annotations

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from checks.registry import queries
from checks.roles import TEST_RULES, LinesOnce, Roles
from martloom.plans import outlets, visits, volume
from martloom.plans.common import outlet_customers

KEYS = {
    "customer": ["c_custkey"], "supplier": ["s_suppkey"], "part": ["p_partkey"], "orders": ["o_custkey"],
    "lineitem": ["l_suppkey", "l_partkey"],
}


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


@pytest.fixture(scope="module")
def far_dir(spark, sf_dir, tmp_path_factory):
    """Some keys are negative or over 32 bits, some days lie before 1970, after 2059 or nowhere, some keys are NULL."""
    out = str(tmp_path_factory.mktemp("far"))
    t = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in [*KEYS, "nation"]}
    t["orders"] = t["orders"].filter("o_orderkey < 400")
    t["lineitem"] = t["lineitem"].filter("l_orderkey < 400").withColumn(
        "l_partkey", F.expr("IF(l_linenumber = 4, NULL, l_partkey)")).withColumn("l_suppkey", F.expr("IF(l_linenumber = 5, NULL, l_suppkey)"))
    for name, day, key in (("orders", "o_orderdate", "o_orderkey"), ("lineitem", "l_shipdate", "l_partkey")):
        t[name] = t[name].withColumn(day, F.expr(
            f"CASE {key} % 7 WHEN 1 THEN {day} - INTERVAL 50 YEARS WHEN 2 THEN {day} + INTERVAL 90 YEARS WHEN 3 THEN NULL ELSE {day} END"))
    for name, keys in KEYS.items():
        for k in keys:
            t[name] = t[name].withColumn(k, F.expr(
                f"CASE {k} % 5 WHEN 0 THEN -1 - {k} WHEN 1 THEN {k} + 3000000000 WHEN 2 THEN {k} + 2147483000 ELSE {k} END"))
    t["customer"] = t["customer"].filter("c_nationkey % 6 != 0").unionByName(
        t["customer"].filter("c_nationkey % 4 = 1").withColumn("c_nationkey", F.col("c_nationkey") + 1))
    for name, df in t.items():
        df.write.parquet(f"{out}/{name}.parquet")
    return out


@pytest.fixture(scope="module")
def kinds(spark, far_dir):
    return Roles(spark, far_dir), LinesOnce(spark, far_dir)


def test_plan_keeps_its_keys(kinds):
    plain, lean = (rows(r.plan().select("YM", "Branch", "Route", "Customer")) for r in kinds)
    assert plain == lean != []
    assert any("'-" in row for row in plain) and any("'300000" in row for row in plain)


def test_planned_outlets_need_no_lookup(kinds):
    plain, lean = kinds
    want = outlets.planned_outlets(plain.plan(), plain.customer(), plain.group())
    found = outlets.planned_outlets(lean.plan(), lean.customer(), lean.group(), "_shops", ("_deal",))
    assert rows(found.select(want.columns)) == rows(want) != []


def test_last_days_are_those_of_the_invoice(kinds):
    plain, lean = (rows(r.last_days()) for r in kinds)
    assert plain == lean != []


def test_visits_keep_their_days(kinds):
    plain, lean = kinds
    want = visits.visit_totals(plain.planned_visits(), plain.actual_visits(), plain.route(), months=None, rules=TEST_RULES)
    found = visits.marked_totals(lean.visits(), lean.route(), rules=TEST_RULES).select(want.columns)
    assert rows(found) == rows(want) != []


@pytest.mark.parametrize("job,last", [(volume.volume_totals, True), (volume.bill_totals, False)])
def test_sold_lines_are_added_up_as_all_are(kinds, job, last):
    plain, lean = kinds
    kw = dict(as_of=date(2001, 8, 1), months=None, rules=TEST_RULES)
    stores = outlet_customers(plain.customer(), plain.group(), TEST_RULES, TEST_RULES.scorecard_excluded_groups, stores_only=True)
    days = [{"last_days": r.last_days()} if last else {} for r in kinds]
    want = job(plain.invoice(), plain.reason(), plain.customer(), plain.material(), **kw, **days[0]).join(
        stores.select(F.col("Customer").alias("CustomerCode")).distinct(), "CustomerCode", "left_semi")
    found = job(lean.described("_store"), lean.reason(), lean.customer(), None, dealt=("_deal",), **kw, **days[1])
    assert rows(found.select(want.columns)) == rows(want) != []


def test_only_lines_of_sales_carry_sales(spark, sf_dir):
    lines = LinesOnce(spark, sf_dir).lines()
    sale = [c for c in lines.columns if c.startswith(("o_", "l_extended", "l_quantity"))]
    assert "o_orderkey" in sale and not [c for c in lines.columns if c.startswith(("p_", "_parts"))]
    carried = lines.filter(F.coalesce(*[F.col(c).cast("string") for c in sale]).isNotNull()).count()
    assert 0 < carried < 0.6 * lines.count()


@pytest.mark.parametrize("name", ["scorecard", "scorecard_parity"])
def test_no_material_lists_and_no_plan_are_moved(spark, sf_dir, name):
    plan = queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "p_partkey" in plan and "_parts" not in plan
    # The plan meets outlets and assets where it is made; an exchange of its own by month and customer would be one more.
    assert not re.search(r"Exchange hashpartitioning\(YM#\d+, Customer#\d+, \d+\), REPARTITION_BY_COL", plan)
