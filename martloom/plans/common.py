"""Filtered dimensions and the sale-line frame shared by the invoice aggregates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions import month_window
from martloom.rules import Rules


def kept_reasons(reason: DataFrame, rules: Rules) -> DataFrame:
    return reason.filter(~F.col("ReasonCode").startswith(rules.excluded_reason_prefix)).select("ReasonCode")


def sold_materials(material: DataFrame, rules: Rules) -> DataFrame:
    """Materials that count as volume. The invoice jobs test these columns in their
    filter, so the material lookup behaves as an inner join."""
    return material.filter(
        (F.col("MaterialType") == rules.material_type)
        & F.col("MatType1Id").isin(*rules.material_type_ids)
        & F.col("PackagingType").isin(*rules.packaging)
        & (F.col("GroupPostMix") != rules.post_mix_group)
    )


def customer_copies(customer: DataFrame, rules: Rules) -> DataFrame:
    """Customers outside the excluded groups with their row count (1 when keys are unique)."""
    return (
        customer.filter(~F.col("CustGrp1").try_cast("int").isin(*rules.excluded_groups))
        .groupBy("HANAFlag", F.col("Customer").alias("CustomerCode"))
        .agg(F.count(F.lit(1)).alias("_copies"))
    )


def sale_lines(
    invoice: DataFrame, reason: DataFrame, material: DataFrame | None, as_of: date | None,
    months: int | None, rules: Rules, material_columns: list[str],
) -> DataFrame:
    """Invoice lines of the window with a counting reason and material, plus litres.

    ``material=None`` says that the lines carry the columns of their material already.

    Only small dimensions are joined here. The customer filter is applied after the
    aggregation, so the fact crosses the network once, combined map-side, and a customer
    holding a large share of the lines never gathers them in one task.
    """
    litre = (F.col("Millilitre") / 1000).cast("decimal(18,7)")
    lines = invoice.filter(month_window(F.col("YM"), as_of, months)).join(kept_reasons(reason, rules), "ReasonCode")
    if material is None:
        lines = sold_materials(lines, rules).withColumn("_litre", litre)
    else:
        products = sold_materials(material, rules).select("Material", *material_columns, litre.alias("_litre"))
        lines = lines.join(products, "Material")
    return (
        lines
        .withColumn("SoldLitre", F.col("SoldBaseQty") * F.col("_litre"))
        .withColumn("FreeLitre", F.col("FreeBaseQty") * F.col("_litre"))
    )


def invoice_keys() -> list[Column]:
    return [
        F.col("HANAFlag"),
        F.concat(F.col("YM"), F.lit("01")).alias("DateKey"),
        F.col("Branch").alias("BranchCode"),
        F.col("Route").alias("RouteCode"),
        F.col("Salesman"),
        F.col("ChannelMarge").alias("ChannelSalesOffice"),
        F.col("Customer").alias("CustomerCode"),
        F.col("DataSource"),
        F.col("BType").alias("BillType"),
    ]


def keep_customers(
    totals: DataFrame, customer: DataFrame, rules: Rules, keys: list[str], counts: list[str], sums: list[str]
) -> DataFrame:
    """Apply the customer inner join to grouped rows.

    A customer listed k times would have repeated each line k times: sums scale by k,
    distinct counts do not change.
    """
    copies = F.col("_copies").cast("decimal(9,0)")

    def times(c: str) -> Column:
        # 28 digits times 9 keep every decimal place; a wider product would be rounded.
        scale = totals.schema[c].dataType.scale
        return (F.col(c).cast(f"decimal(28,{scale})") * copies).alias(c)
    return totals.join(customer_copies(customer, rules), ["HANAFlag", "CustomerCode"]).select(
        *keys, *counts, *[times(c) for c in sums])


def channel_flags(channel: DataFrame, config: DataFrame) -> DataFrame:
    """Channel -> post-mix flag through the configuration table (repeats are kept)."""
    return channel.join(config, channel["SalesOfficeDesc"] == config["Value1"]).select(
        "ChannelMarge", "SalesOfficeDesc", F.col("Value2").alias("PostMixFlag")
    )


def customer_shops(customer: DataFrame, group: DataFrame) -> DataFrame:
    """Customer with the group attributes; customers without a group keep NULLs."""
    groups = group.select("CustGrp", "ShopType")
    return customer.select(
        "HANAFlag", "Customer", "SpecialGrp1", "CustType", F.col("CustGrp1").try_cast("int").alias("_group")
    ).join(groups, F.col("_group") == F.col("CustGrp"), "left").drop("_group")


def outlet_customers(
    customer: DataFrame, group: DataFrame, rules: Rules, excluded: tuple[int, ...], stores_only: bool = False
) -> DataFrame:
    """Customers that count as sales outlets."""
    kept = (
        ~F.col("ShopType").isin(*rules.excluded_shops)
        & F.col("SpecialGrp1").isin(*rules.special_groups)
        & ~F.col("Customer").startswith(rules.employee_prefix)
        & ~F.col("CustGrp").isin(*excluded)
    )
    if stores_only:
        kept = kept & (F.col("CustType") == rules.store_type)
    return customer_shops(customer, group).filter(kept)
