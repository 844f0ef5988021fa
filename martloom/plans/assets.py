"""Asset aggregates: counts by status, and sales allocated to coolers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.rules import DEFAULT_RULES, Rules


def asset_counts(asset: DataFrame) -> DataFrame:
    return asset.groupBy(
        F.concat(F.col("YM"), F.lit("01")).alias("DateKey"),
        F.col("BranchByVP").alias("BranchCode"), F.col("VPRoute").alias("RouteCode"),
        "ActiveStatus", "AssetStatus", "AssetType",
    ).agg(F.count(F.lit(1)).alias("NoofCooler"))


def cooler_sales(asset: DataFrame, volume: DataFrame, *, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Monthly sales of a customer, spread over the coolers placed there by sub-type.

    Assets are counted before they meet the sales, so a customer with very many coolers
    joins as one row per place. Counts by sub-type attach on month and customer alone: a
    customer on two routes shows the full counts on each.
    """
    coolers = asset.filter(F.col("AssetType") == rules.cooler_asset)
    placed = coolers.groupBy(
        F.col("YM"), F.coalesce("BranchByVP", "BranchByAsset").alias("BranchCode"),
        F.col("VPRoute").alias("RouteCode"), F.col("Customer").alias("CustomerCode"),
    ).agg(F.count(F.lit(1)).alias("_assets"))
    sales = (
        volume.filter(F.coalesce("BrandDesc", F.lit("0")) != rules.cooler_excluded_brand)
        .groupBy("DateKey", "CustomerCode").agg(F.sum("TotalAmount").alias("_total"))
        # One row per month and customer; several date keys of a month repeat each asset.
        .groupBy(F.left("DateKey", F.lit(6)).alias("YM"), "CustomerCode")
        .agg(F.max("_total").alias("_total"), F.count(F.lit(1)).alias("_days"))
    )
    coolers_here = (F.col("_assets") * F.coalesce("_days", F.lit(1))).cast("decimal(18,0)")
    per_cooler = placed.join(sales, ["YM", "CustomerCode"], "left").withColumn("_coolers", coolers_here)
    kinds = coolers.groupBy("YM", F.col("Customer").alias("CustomerCode"), "AssetSubType").agg(
        F.count(F.lit(1)).alias("NoOfCooler")
    )
    return per_cooler.join(kinds, ["YM", "CustomerCode"], "left").select(
        F.concat_ws("", "YM", F.lit("01")).alias("DateKey"), "BranchCode",
        F.coalesce("RouteCode", F.lit("")).alias("RouteCode"), "CustomerCode", "AssetSubType", "NoOfCooler",
        # Multiplied first, so the one division is the only rounding.
        ((F.col("_total").cast("decimal(20,4)") * F.col("NoOfCooler").cast("decimal(9,0)")) / F.col("_coolers"))
        .cast("decimal(28,4)").alias("AmountByAsset"),
    )
