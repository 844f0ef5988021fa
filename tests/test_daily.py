"""The aggregate refresh on a stored mart: totals, repeatability, late lines."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from checks.roles import AS_OF, TEST_RULES, Roles
from martloom.functions import ym
from martloom.plans import facts, outlets, visits, volume
from checks.registry import filled_table
from martloom.plans.daily import (
    BRANCH_TARGETS, COPIED, DERIVED, FACT_DAYS, LAST_DAYS, STEPS, load_dimensions, load_facts, load_targets, refresh_aggregates,
)
from martloom.sinks import Mart
from martloom.sinks.store import with_month


@pytest.fixture(scope="module")
def mart(spark, sf_dir, tmp_path_factory):
    mart, r = Mart(spark, str(tmp_path_factory.mktemp("mart"))), Roles(spark, sf_dir)
    mart.overwrite("FactAllDataInvoice", facts.invoices(r.stage_invoice(), r.material(), days=None), "YM")
    tables = {
        "DimReason": r.reason(), "DimCustomer": r.customer(), "DimMaterial": r.material(), "DimCustGrp1": r.group(),
        "DimChannel": r.channel(), "Config": r.config(), "DimRoute": r.route(), "DimLocation": r.location(),
        "FactVisitList": r.planned_visits(), "FactActualVisit": r.actual_visits(), "FactCustPerMonPlan": r.plan(),
        "FactDataAsset": facts.assets(r.stage_asset(), r.plan(), days=None),
    }
    for name, df in tables.items():
        mart.overwrite(name, df)
    for name, day in (("FactVisitList", "AssignedDate"), ("FactActualVisit", "VisitDate")):
        mart.overwrite(name, tables[name].withColumn("visit_ym", ym(F.col(day))), "visit_ym")
    days = mart.read("FactAllDataInvoice").groupBy("YM").agg(F.max("DateKey").alias("LastDay"))
    mart.overwrite(LAST_DAYS, days)
    return mart


def content(mart, table):
    df = mart.read(table)
    assert "PYLoadDate" in df.columns
    df = df.drop("PYLoadDate")
    return sorted(map(str, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))


def test_refresh_twice_is_a_no_op(mart):
    written = refresh_aggregates(mart, AS_OF, rules=TEST_RULES)
    assert list(written) == [s.table for s in STEPS] + list(DERIVED) and all(written.values())
    first = {t: content(mart, t) for t in written}
    again = refresh_aggregates(mart, AS_OF, rules=TEST_RULES)
    assert {t: again[t] for t in again if t not in DERIVED} == {t: written[t] for t in written if t not in DERIVED}
    assert {t: content(mart, t) for t in written} == first
    # The stored table of last days gives what the whole fact gives.
    whole = volume.volume_by_brand(*[mart.read(n) for n in ("FactAllDataInvoice", "DimReason", "DimCustomer", "DimMaterial")],
                                   as_of=AS_OF, rules=TEST_RULES)
    stored = mart.read("AggInvVolByBrandYM")
    assert sorted(map(str, whole.collect())) == sorted(map(str, stored.select(*whole.columns).collect()))


def test_untouched_months_keep_their_files(mart):
    """Of the tables made of other aggregates, only the window is written; a rebuild gives the same rows."""
    refresh_aggregates(mart, AS_OF, rules=TEST_RULES, only=set(DERIVED), rebuild=True)
    months = {t: sorted(v[0] for v in mart.partitions(t, ("ym",))) for t in DERIVED}
    old = {t: os.listdir(f"{mart.path(t)}/ym={months[t][0]}") for t in DERIVED}
    before = {t: content(mart, t) for t in DERIVED}
    refresh_aggregates(mart, AS_OF, rules=TEST_RULES, only=set(DERIVED))
    assert min(map(min, months.values())) < "200103"
    assert {t: os.listdir(f"{mart.path(t)}/ym={months[t][0]}") for t in DERIVED} == old
    assert {t: content(mart, t) for t in DERIVED} == before


def test_late_assets_of_old_months_reach_the_derived_tables(spark, sf_dir, tmp_path):
    """An asset loaded today into a month far before any window changes that month, and no other one."""
    mart, r = Mart(spark, str(tmp_path)), Roles(spark, sf_dir)
    for name, df in {"DimReason": r.reason(), "DimCustomer": r.customer(), "DimMaterial": r.material(), "DimRoute": r.route(),
                     "DimCustGrp1": r.group(), "DimChannel": r.channel(), "Config": r.config(),
                     "DimLocation": r.location()}.items():
        mart.overwrite(name, df)
    invoice = facts.invoices(r.stage_invoice(), r.material(), days=None)
    mart.overwrite("AggInvVolByBrandYM", with_month(volume.volume_by_brand(
        invoice, r.reason(), r.customer(), r.material(), months=None, rules=TEST_RULES)), "ym")
    mart.overwrite("AggInvBillBrandYM", with_month(volume.bills(
        invoice, r.reason(), r.customer(), r.material(), months=None, rules=TEST_RULES)), "ym")
    mart.overwrite("AggVisitCallYM", with_month(visits.visit_calls(
        r.planned_visits(), r.actual_visits(), r.route(), as_of=AS_OF, months=None, rules=TEST_RULES)), "ym")
    mart.overwrite("AggActOutletYM", with_month(outlets.active_outlets(
        invoice, r.plan(), r.reason(), r.channel(), r.config(), r.material(), r.customer(), r.group(), r.route(), r.location(),
        months=None, rules=TEST_RULES)), "ym")
    assets = facts.assets(r.stage_asset(), r.plan(), days=None).withColumn("etl_date", F.lit("2001-01-01"))
    mart.overwrite("FactDataAsset", assets, ("YM", "etl_date"))
    only = set(DERIVED)
    assert all(refresh_aggregates(mart, AS_OF, rules=TEST_RULES, only=only).values())
    assert refresh_aggregates(mart, AS_OF, rules=TEST_RULES, only=only) == {t: 0 for t in DERIVED}

    months = [v[0] for v in mart.partitions("AggAssetCoolerYM", ("ym",))]
    old = sorted(m for m in months if m < "199801")[0]
    files = {(t, m): sorted(os.listdir(f"{mart.path(t)}/ym={m}")) for t in DERIVED for m, in mart.partitions(t, ("ym",))}
    cooler = content(mart, "AggAssetCoolerYM")
    late = mart.read("FactDataAsset").filter(F.col("YM") == old).filter(
        F.col("AssetType") == TEST_RULES.cooler_asset).limit(3).withColumn("etl_date", F.lit("2001-08-01"))
    assert mart.append("FactDataAsset", late, ("YM", "etl_date")) == 3
    again = refresh_aggregates(mart, AS_OF, rules=TEST_RULES, only=only)
    assert all(again.values()) and content(mart, "AggAssetCoolerYM") != cooler
    now = {(t, m): sorted(os.listdir(f"{mart.path(t)}/ym={m}")) for t, m in files}
    assert {k for k in files if files[k] != now[k]} == {(t, old) for t in DERIVED}
    found = {t: content(mart, t) for t in DERIVED}
    refresh_aggregates(mart, AS_OF, rules=TEST_RULES, only=only, rebuild=True)
    assert {t: content(mart, t) for t in DERIVED} == found

    # A month that vanishes from a source vanishes here.
    kept = mart.read("FactDataAsset").filter(F.col("YM") != old)
    mart.overwrite("FactDataAsset", kept, ("YM", "etl_date"))
    refresh_aggregates(mart, AS_OF, rules=TEST_RULES, only=only)
    assert mart.read("AggAssetCoolerYM").filter(F.col("ym") == old).count() == 0


def test_volume_totals_agree_with_the_invoice(mart):
    volume = mart.read("AggInvVolByBrandYM")
    lines = mart.read("FactAllDataInvoice").filter("YM >= '200103' AND ReasonCode NOT LIKE '6%'").join(
        mart.read("DimMaterial").filter("MaterialType = 'Z31' AND MatType1Id IN (1, 8) AND PackagingType IN ('NR', 'RB')"
                                        " AND GroupPostMix <> 'PostMix'"), "Material", "left_semi"
    ).join(mart.read("DimCustomer").filter("CustGrp1 NOT IN ('131', '132', '134', '139')"),
           ["HANAFlag", "Customer"], "left_semi")
    want = lines.agg(F.sum("TotalAmt"), F.sum("SoldBaseQty")).first()
    got = volume.agg(F.sum("TotalAmount"), F.sum("SoldBaseQty")).first()
    assert tuple(map(float, got)) == tuple(map(float, want))


def test_late_line_inside_the_window_appears(mart):
    invoice = mart.read("FactAllDataInvoice")
    before = mart.read("AggInvVolByBrandYM").agg(F.sum("SoldBaseQty")).first()[0]
    keys = mart.read("AggInvVolByBrandYM").select(
        F.col("CustomerCode").alias("Customer"), F.left("DateKey", F.lit(6)).alias("YM"),
        F.col("RouteCode").alias("Route")).distinct()
    late = invoice.filter("ReasonCode = ''").join(keys, ["Customer", "YM", "Route"], "left_semi").join(
        mart.read("DimMaterial").filter("MaterialType = 'Z31' AND MatType1Id IN (1, 8) AND PackagingType IN ('NR', 'RB')"
                                        " AND GroupPostMix <> 'PostMix'"), "Material", "left_semi")
    assert late.count() > 0
    added = late.agg(F.sum("SoldBaseQty")).first()[0]
    out_of_window = invoice.filter("YM = '199801'")
    mart.overwrite("FactAllDataInvoice", invoice.unionByName(late).unionByName(out_of_window), "YM")
    refresh_aggregates(mart, AS_OF, rules=TEST_RULES, only={"AggInvVolByBrandYM"})
    assert mart.read("AggInvVolByBrandYM").agg(F.sum("SoldBaseQty")).first()[0] == before + added


@pytest.fixture(scope="module")
def loads(spark, sf_dir, tmp_path_factory):
    """An empty mart with its stages and sheets."""
    r = Roles(spark, sf_dir)
    stages = {name: (lambda n=name: filled_table(r, n)) for name in COPIED} | {
        "DimCustomerOld": lambda: filled_table(r, "DimCustomerOld").withColumns(
            {"LONGITUDE": F.lit("10.5"), "LATITUDE": F.lit("20.5")}),
        "DimMaterial": lambda: filled_table(r, "DimMaterial").withColumn("Material", F.split("Material", "-")[1]),
        "DimCustomer": r.new_customers, "DimLocation": r.stage_location, "DimRoute": r.route_stage,
        "DimSalesman": r.salesman_stage, "DimBillingDate": r.calendar, "FactCustPerMonPlan": r.plan,
    }
    # All rows, loaded once a month: a directory per load day would make this test write thousands.
    recent = {"FactAllDataInvoice": r.stage_invoice, "FactVisitList": r.planned_visits,
              "FactActualVisit": r.actual_visits, "FactDataAsset": r.stage_asset}
    stages |= {n: (lambda f=f: f().withColumn("ETLLoadData", F.date_trunc("MONTH", "ETLLoadData").cast("timestamp_ntz")))
               for n, f in recent.items()}
    sheets = {"DimLocation": r.location_sheet, "DimRoute": r.route_sheet, "DimSalesman": r.salesman_sheet,
              "DimBillingDate": r.workdays, "FactAOPTDM": r.manager_sheet, "FactAOPNDTDM": r.manager_sheet}
    sheets |= {t: (r.route_targets if "Route" in t else r.branch_targets) for t in BRANCH_TARGETS}
    mart = Mart(spark, str(tmp_path_factory.mktemp("loads")))
    return mart, lambda n: stages[n](), lambda n: sheets[n](), r.boundary()


def test_nightly_loads_repeat_without_duplicates(loads):
    mart, stage, sheet, boundary = loads
    assert all(load_dimensions(mart, stage, sheet, boundary, cell=5.0).values())
    full = load_facts(mart, stage, AS_OF, full=True, visits_since="199501")
    sizes = {t: mart.read(t).count() for t in full}
    assert sizes == full and sizes["FactAllDataInvoice"] == stage("FactAllDataInvoice").count()
    for _ in range(2):
        nightly = load_facts(mart, stage, AS_OF)
        assert all(0 < nightly[t] < full[t] for t in FACT_DAYS)
        assert {t: mart.read(t).count() for t in sizes} == sizes
    days = mart.read("FactAllDataInvoice").groupBy("YM").agg(F.max("DateKey").alias("LastDay"))
    assert sorted(days.collect()) == sorted(mart.read(LAST_DAYS).select("YM", "LastDay").collect())


def test_windows_prune_the_loaded_facts(loads, spark, sf_dir):
    """Month bounds of the aggregates are partition filters on the tables that load_facts wrote."""
    mart, r = loads[0], Roles(spark, sf_dir)
    dims = {"DimReason": r.reason, "DimCustomer": r.customer, "DimMaterial": r.material, "DimRoute": r.route,
            "DimChannel": r.channel, "Config": r.config, "DimCustGrp1": r.group, "DimLocation": r.location}

    def table(name):
        return dims[name]() if name in dims else mart.read(name)
    for step in STEPS[:5]:
        plan = step.build(table, AS_OF, TEST_RULES)._jdf.queryExecution().executedPlan().toString()
        fact, key = ("visit", "visit_ym") if step.table == "AggVisitCallYM" else ("Invoice", "YM")
        scans = [x for x in plan.splitlines() if f"{key}#" in x and "FileScan" in x and "PartitionFilters" in x]
        assert scans, step.table
        assert all(f"({key}#" in x.split("PartitionFilters")[1].split("PushedFilters")[0] and ">= 2001" in x for x in scans
                   if "etl_date" in x), step.table


def test_targets_repeat_without_duplicates(loads):
    mart, _, sheet, _ = loads
    first = load_targets(mart, sheet)
    assert len(first) == 14 and load_targets(mart, sheet) == first
    assert {t: mart.read(t).count() for t in first} == first
    # Branch targets carry the load time of their landing, manager targets their own.
    landed = mart.read("FactAOPExcel").agg(F.max("PYLoadDate")).first()[0]
    assert mart.read("FactAOP").agg(F.max("PYLoadDate")).first()[0] == landed
    assert load_targets(mart, lambda n: sheet(n).filter("false")) == {}
