"""Amounts without loss, and differences that sums hide."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from martloom.operators import drill_down, recon
from martloom.plans.assets import cooler_sales
from martloom.plans.common import keep_customers
from martloom.rules import DEFAULT_RULES


def test_repeated_customer_scales_sums_without_rounding(spark):
    totals = spark.createDataFrame([(1, "c", Decimal("0.00123450001"))], "HANAFlag int, CustomerCode string, "
                                   "SoldLitre decimal(38,11)")
    customer = spark.createDataFrame([(1, "c", "100"), (1, "c", "100")], "HANAFlag int, Customer string, CustGrp1 string")
    row = keep_customers(totals, customer, DEFAULT_RULES, ["CustomerCode"], [], ["SoldLitre"]).first()
    assert row["SoldLitre"] == Decimal("0.00246900002")


def test_cooler_amounts_are_decimal(spark):
    cooler = DEFAULT_RULES.cooler_asset
    asset = spark.createDataFrame(
        [("202401", "b", "b", "r", "c", cooler, k) for k in ("x", "x", "y")],
        "YM string, BranchByVP string, BranchByAsset string, VPRoute string, Customer string, AssetType string, "
        "AssetSubType string")
    volume = spark.createDataFrame([("20240101", "c", "any", Decimal("900000000000.0003"))],
                                   "DateKey string, CustomerCode string, BrandDesc string, TotalAmount decimal(38,4)")
    rows = {r["AssetSubType"]: r["AmountByAsset"] for r in cooler_sales(asset, volume).collect()}
    assert rows == {"x": Decimal("600000000000.0002"), "y": Decimal("300000000000.0001")}


def test_recon_sees_swapped_values_and_null_against_zero(spark):
    schema = "k string, item string, n int, m int"
    left = spark.createDataFrame([("a", "x", 1, 5), ("a", "y", 2, 5), ("b", "x", None, 1), ("c", "x", 7, 7)], schema)
    right = spark.createDataFrame([("a", "x", 2, 5), ("a", "y", 1, 5), ("b", "x", 0, 1), ("c", "x", 7, 7)], schema)
    found = recon(left, right, ["k"], ["n", "m"])
    assert {r["k"] for r in found.collect()} == {"a", "b"}
    assert recon(left, left.withColumn("m", F.col("m")), ["k"], ["n", "m"]).isEmpty()


def test_drill_down_equals_recon_and_reads_differing_months(spark, tmp_path):
    schema = "ym string, branch string, k string, n int, m int"
    same = [("202401", b, str(i), i, i) for b in ("x", None) for i in range(5)]
    left = same + [("202402", "x", "1", 1, 1), ("202402", "x", "2", 2, 1), ("202402", "y", "1", 4, 4), ("202403", None, "1", 3, None),
                   (None, "x", "1", 1, 1), ("202404", "x", "1", 1, 1)]
    right = same + [("202402", "x", "1", 2, 1), ("202402", "x", "2", 1, 1), ("202402", "y", "1", 4, 4), ("202403", None, "1", 3, 0),
                    (None, "x", "1", 2, 1), ("202404", "y", "1", 1, 1)]
    sides = []
    for name, rows in (("left", left), ("right", right)):
        spark.createDataFrame(rows, schema).write.partitionBy("ym").parquet(str(tmp_path / name))
        sides.append(spark.read.schema(schema).parquet(str(tmp_path / name)))
    for levels in (["ym"], ["ym", "branch"], ["ym", "branch", "k"]):
        found = drill_down(*sides, levels, ["n", "m"])
        whole = recon(*sides, levels, ["n", "m"])
        assert sorted(map(str, found.collect())) == sorted(map(str, whole.select(found.columns).collect()))
        assert not whole.isEmpty()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ym#" in plan and "202402" in plan and "202401" not in plan and "PartitionFilters: [" in plan
    assert drill_down(sides[0], sides[0], ["ym", "branch", "k"], ["n"]).isEmpty()
