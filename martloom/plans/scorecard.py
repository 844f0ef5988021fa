"""Wide monthly scorecard over the stored aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.plans.common import channel_flags, customer_shops, outlet_customers
from martloom.rules import DEFAULT_RULES, Rules

KEYS = ["DateKey", "BranchCode", "RouteCode"]
# output suffix -> measure of the volume aggregate
MEASURES = {
    "Case": "SoldCase", "CaseLastDay": "SoldCaseLastDay", "Litre": "SoldLitre",
    "NetAmount": "NetItemAmt", "TotalAmount": "TotalAmount",
}
SIDE_MEASURES = [
    "TotalOutletVP", "ActiveOutletVP", "ActiveBrandOutletVL", "NoOfBrandOutletVL",
    "NoOfPlanVisit", "NoOfActualVisit", "NoOfBill", "NoOfBrand",
]


def _sold_to_outlets(
    sales: DataFrame, flags: DataFrame, customer: DataFrame, group: DataFrame, rules: Rules
) -> DataFrame:
    outlets = outlet_customers(customer, group, rules, rules.scorecard_excluded_groups, stores_only=True)
    return sales.join(flags, sales["ChannelSalesOffice"] == flags["ChannelMarge"]).join(
        outlets.select("HANAFlag", F.col("Customer").alias("CustomerCode")), ["HANAFlag", "CustomerCode"]
    )


def _brand_volume(
    volume: DataFrame, flags: DataFrame, customer: DataFrame, group: DataFrame, rules: Rules
) -> DataFrame:
    """Five measures per key, post-mix flag and brand bucket; spread over columns later."""
    mix = (F.coalesce(F.col("PostMixFlag") == rules.post_mix_flag, F.lit(False))).cast("int")
    return _sold_to_outlets(volume, flags, customer, group, rules).groupBy(
        *KEYS, mix.alias("_mix"), "Brand"
    ).agg(*[F.sum(m).alias(m) for m in MEASURES.values()])


def scorecard(
    volume: DataFrame, bills: DataFrame, visits: DataFrame, outlets: DataFrame, coolers: DataFrame,
    channel: DataFrame, config: DataFrame, customer: DataFrame, group: DataFrame, *,
    rules: Rules = DEFAULT_RULES, parity: bool = False,
) -> DataFrame:
    """One row per month, branch and route with brand volumes, outlets, visits and bills.

    All inputs meet in one union and one aggregation on the three keys: one exchange of
    rows added up per source in place of a distinct key spine and four joins. Bills do not create
    keys. A key holding a NULL stays but shows no measures.

    A key sold through post-mix and other channels has two volume rows. ``parity=True``
    repeats the visits, bills and outlets once per volume row, as a join to the
    uncollapsed volume does; the default counts them once.
    """
    flags = channel_flags(channel, config)
    per_brand = _brand_volume(volume, flags, customer, group, rules)
    sold_bills = _sold_to_outlets(bills, flags, customer, group, rules).groupBy(*KEYS).agg(
        F.sum(F.col("NoOfBill") - F.col("NoOfBillCN")).alias("NoOfBill"),
        F.sum(F.col("NoOfBrand") - F.col("NoOfBrandCN")).alias("NoOfBrand"), F.lit(0).alias("_spine"),
    )
    shops = customer_shops(customer.filter(F.col("HANAFlag") == 1), group)
    placed = shops.filter(F.col("ShopType").isin(*rules.cooler_shops)).select(
        F.col("Customer").alias("CustomerCode")
    ).distinct()
    # Distinct first: only the keys of the cooler table are used, so when it is computed in
    # the same plan Spark can drop the sales and sub-type lookups behind it.
    cooler_keys = coolers.select(
        "DateKey", "BranchCode", F.coalesce("RouteCode", F.lit("")).alias("RouteCode"), "CustomerCode"
    ).distinct().join(placed, "CustomerCode", "left_semi").select(*KEYS).distinct().withColumn("_spine", F.lit(1))
    sources = [
        per_brand.withColumn("_spine", F.lit(1)),
        sold_bills,
        visits.select(*KEYS, "NoOfPlanVisit", "NoOfActualVisit", F.lit(1).alias("_spine")),
        outlets.select(
            *KEYS, "TotalOutletVP", "ActiveOutletVP", "ActiveBrandOutletVL", "NoOfBrandOutletVL",
            F.lit(1).alias("_spine"),
        ),
        cooler_keys,
    ]
    rows = sources[0]
    for extra in sources[1:]:
        rows = rows.unionByName(extra, allowMissingColumns=True)
    # Each source has few rows a key by now. They move as they are: combined map-side, each would carry thirty sums.
    rows = rows.repartition(*KEYS)

    sold = F.col("_mix").isNotNull()
    brand = F.col("Brand")
    buckets = {
        "Est": brand == rules.brands["Est"],
        "Crystal": brand == rules.brands["Crystal"],
        "Oishi": rules.in_family(brand),
        "Wrangyer": brand == rules.brands["Wrangyer"],
        "OtherBrand": brand == rules.other_brand,
    }
    wide = {
        f"{label}{suffix}": F.sum(F.when(test, F.col(measure)).when(sold, F.lit(0)))
        for label, test in buckets.items() for suffix, measure in MEASURES.items()
    }
    wide |= {f"TotalBrand{suffix}": F.sum(measure) for suffix, measure in MEASURES.items()}
    grouped = rows.groupBy(*KEYS).agg(
        F.max("_spine").alias("_spine"),
        F.max("_mix").alias("_mix_hi"), F.min("_mix").alias("_mix_lo"),
        *[expr.alias(name) for name, expr in wide.items()],
        *[F.sum(m).alias(m) for m in SIDE_MEASURES],
    ).filter(F.col("_spine") == 1)

    whole = F.col("DateKey").isNotNull() & F.col("BranchCode").isNotNull() & F.col("RouteCode").isNotNull()
    repeats = F.when(F.col("_mix_hi") != F.col("_mix_lo"), 2).otherwise(1) if parity else F.lit(1)
    return grouped.select(
        *KEYS,
        F.coalesce(F.when(whole, F.col("_mix_hi")), F.lit(0)).alias("PostMixFlag"),
        *[F.when(whole, F.col(name)).alias(name) for name in wide],
        *[F.when(whole, F.col(m) * repeats).alias(m) for m in SIDE_MEASURES],
    )
