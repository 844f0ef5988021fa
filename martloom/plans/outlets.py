"""Active outlets per planned route and per brand route."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions import concat_blank, month_window, next_month
from martloom.plans.common import channel_flags, customer_shops, outlet_customers, sold_materials
from martloom.rules import DEFAULT_RULES, Rules

KEYS = ["DateKey", "BranchCode", "RouteCode", "ShopType"]
BRAND_COUNTS = [
    "EstActiveOutletVL", "CrystalActiveOutletVL", "OishiActiveOutletVL", "OishiGreenTeaActiveOutletVL",
    "OishiChakulzaActiveOutletVL", "WrangyerActiveOutletVL", "FSRRBActiveOutletVL",
    "ActiveBrandOutletVL", "NoOfBrandOutletVL", "ActiveBrandOutletVLExOishi",
]
# Brand counts that are the sum of one mark per buyer.
MARKS = [c for c in BRAND_COUNTS if c not in ("ActiveBrandOutletVL", "NoOfBrandOutletVL")]
PLACE = ["_by_route", "YM", "Branch", "Route", "ShopType"]


def planned_outlets(
    plan: DataFrame, customer: DataFrame, group: DataFrame, shops: str | None = None, dealt: tuple[str, ...] = ()
) -> DataFrame:
    """Planned customers, once per route and shop type; the plan of a month is the base of the next.

    ``shops`` names a column of the plan that lists the shop types of its customer, which then need no lookup; ``dealt`` columns that
    follow from month and route and by which the plan is dealt.
    """
    if shops is None:
        types = customer_shops(customer.filter(F.col("HANAFlag") == 1), group).select("Customer", "ShopType")
        typed = plan.select(*dealt, "YM", "Branch", "Route", "Customer").join(types, "Customer", "left")
    else:
        typed = plan.select(*dealt, "YM", "Branch", "Route", "Customer", F.explode(shops).alias("ShopType"))
    return typed.select(
        *dealt, next_month(F.col("YM")).alias("YM"), "Branch", "Route", "ShopType", "Customer"
    ).filter(F.col("Customer").isNotNull()).distinct().drop(*dealt)


def _sold(
    invoice: DataFrame, reason: DataFrame, channel: DataFrame, config: DataFrame, material: DataFrame | None,
    customer: DataFrame, group: DataFrame, rules: Rules, dealt: tuple[str, ...] = (),
) -> DataFrame:
    """Distinct (month, customer, branch, route, flag, brand, packaging) of counting sales.

    De-duplicated before the customer lookup: only small dimensions meet the raw lines,
    and nothing downstream depends on how often a combination occurs.
    """
    flags = channel_flags(channel, config).filter(F.col("SalesOfficeDesc").isin(*rules.sales_offices))
    counting = (
        invoice.filter(F.col("BType") == rules.tax_bill)
        .join(reason.filter(F.col("ReasonCode") == rules.sale_reason).select("ReasonCode"), "ReasonCode")
        .join(flags.select("ChannelMarge", "PostMixFlag").distinct(), "ChannelMarge")
    )
    sales = (
        sold_materials(counting, rules) if material is None
        else counting.join(sold_materials(material, rules).select("Material", "BrandDesc", "PackagingType"), "Material")
    )
    sales = (
        sales.select(
            *dealt, "YM", "HANAFlag", "Customer", "Branch", "VL", "BrandDesc", "PackagingType",
            # Only this much of the flag is tested; NULL keeps its own meaning.
            (F.col("PostMixFlag") == rules.post_mix_flag).alias("PostMix"),
        )
        .distinct().drop(*dealt)
    )
    outlets = outlet_customers(customer, group, rules, rules.excluded_groups)
    # Dealt by the key of the join, which then needs no exchange of its own.
    shops = outlets.select("HANAFlag", "Customer", "ShopType").repartition("HANAFlag", "Customer").distinct()
    return sales.join(shops, ["HANAFlag", "Customer"])


def _brand_marks(rules: Rules) -> list[Column]:
    brand, named = F.col("BrandDesc"), rules.brands
    tests = {
        "EstActiveOutletVL": brand == named["Est"],
        "CrystalActiveOutletVL": brand == named["Crystal"],
        "OishiActiveOutletVL": rules.in_family(brand),
        "OishiGreenTeaActiveOutletVL": brand == named["OishiGreenTea"],
        "OishiChakulzaActiveOutletVL": brand == named["OishiChakulza"],
        "WrangyerActiveOutletVL": brand == named["Wrangyer"],
        "FSRRBActiveOutletVL":
            (F.col("ShopType") == rules.food_shop) & (F.col("PackagingType") == rules.returnable_packaging),
        "ActiveBrandOutletVLExOishi": ~rules.in_family(brand),
    }
    return [F.max(F.coalesce(test, F.lit(False)).cast("int")).alias(name) for name, test in tests.items()]


def _dealt(df: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    return df.repartition(*keys) if tasks is None else df.repartition(tasks, *keys)


def buyer_marks(
    sales: DataFrame, route: DataFrame, location: DataFrame, rules: Rules, tasks: int | None = None
) -> DataFrame:
    """One row per month, buyer, shop type and place of sale: its brand marks and number of brands.

    A sale counts at two places: for the plan at its own branch, for the brands at its route and the
    route's branch (`_by_route`). Post-mix sales of branches that do not count them are dropped at that place only.
    Rows stay dealt by month and buyer, so all groupings up to the counts of a route run where the rows are.
    """
    routes = route.select(F.col("Route").alias("VL"), "BranchVL")
    px = location.select(F.col("BranchCode").alias("_branch"), "PxIncludeFlag")
    no = F.lit(None).cast("string")
    places = F.array(
        F.struct(F.lit(False).alias("_by_route"), F.col("YM").alias("_month"), F.col("Branch").cast("string").alias("_at"),
                 no.alias("_route")),
        # A route without a month or a branch counts under blanks, as its keys are written.
        F.struct(F.lit(True).alias("_by_route"), F.col("_ym").alias("_month"), F.col("BranchVL").cast("string").alias("_at"),
                 F.coalesce("VL", F.lit("")).alias("_route")),
    )
    placed = (
        _dealt(sales.withColumn("_ym", F.coalesce("YM", F.lit(""))), tasks, "_ym", "Customer")
        .join(routes, "VL", "left")
        .select("_ym", "Customer", "ShopType", "BrandDesc", "PackagingType", "PostMix", F.inline(places))
        .join(px, F.col("_at") == F.col("_branch"), "left")
        .filter(~((F.coalesce("PxIncludeFlag", F.lit(0)) == 0) & F.col("PostMix")))
        .withColumn("_at", F.when(F.col("_by_route"), F.coalesce("_at", F.lit(""))).otherwise(F.col("_at")))
    )
    place = ["_ym", "Customer", "ShopType", "_by_route", "_month", "_at", "_route"]
    pairs = placed.groupBy(*place, F.coalesce("BrandDesc", F.lit("")).alias("_brand")).agg(*_brand_marks(rules))
    return pairs.groupBy(*place).agg(
        *[F.max(n).alias(n) for n in MARKS], F.count(F.lit(1)).alias("NoOfBrandOutletVL")
    )


def outlet_counts(buyers: DataFrame, plan: DataFrame, planned: DataFrame, tasks: int | None = None) -> DataFrame:
    """Counts per place: buyers on their planned routes, off-plan buyers where they bought, planned outlets, brands."""
    routes = _dealt(plan.filter(F.col("YM").isNotNull() & F.col("Customer").isNotNull()).select(
        F.col("YM").alias("_p_ym"), F.col("Customer").alias("_p_customer"), F.col("Branch").alias("_p_branch"),
        F.col("Route").alias("_p_route"),
    ), tasks, "_p_ym", "_p_customer").distinct()
    met = buyers.join(
        routes,
        (F.col("_ym") == F.col("_p_ym")) & (F.col("Customer") == F.col("_p_customer"))
        & ~F.col("_by_route") & F.col("_month").isNotNull(),
        "left",
    )
    on_plan = F.col("_p_customer").isNotNull()
    at = F.coalesce("_p_branch", "_at")
    to = F.when(F.col("_by_route"), F.col("_route")).when(on_plan, F.col("_p_route")).otherwise(F.lit(""))
    active = met.groupBy(
        "_ym", "Customer", "_by_route", F.col("_month").alias("YM"), at.alias("Branch"), to.alias("Route"), "ShopType"
    ).agg(
        *[F.max(n).alias(n) for n in [*MARKS, "NoOfBrandOutletVL"]],
        F.max(on_plan & F.col("_p_branch").isNotNull() & F.col("_p_route").isNotNull()).alias("_planned"),
        F.lit(1).alias("_active"),
    ).drop("_ym", "Customer")
    base = planned.select(
        F.lit(False).alias("_by_route"), "YM", "Branch", "Route", "ShopType", F.lit(1).alias("_base"))
    return active.unionByName(base, allowMissingColumns=True).groupBy(*PLACE).agg(
        *[F.sum(n).alias(n) for n in [*MARKS, "NoOfBrandOutletVL"]],
        F.sum("_active").alias("_active"), F.sum("_base").alias("_base"), F.max("_planned").alias("_planned"),
    )


def _rows(counts: DataFrame) -> DataFrame:
    """Rows of the result, one or two per place: a plan total meets only buyers on the plan, else it stands alone."""
    key_known = F.lit(True)
    for key in PLACE[1:]:
        key_known = key_known & F.col(key).isNotNull()
    bought, based = F.col("_active").isNotNull(), F.col("_base").isNotNull()
    meets = key_known & bought & based & F.coalesce("_planned", F.lit(False))
    by_route = F.col("_by_route")
    day = concat_blank(F.col("YM"), F.lit("01")).alias("DateKey")
    nothing = F.lit(None).cast("bigint")
    brands = {**{n: F.col(n) for n in MARKS}, "ActiveBrandOutletVL": F.col("_active"),
              "NoOfBrandOutletVL": F.col("NoOfBrandOutletVL")}
    sold = F.struct(
        day, F.col("Branch").alias("BranchCode"), F.col("Route").alias("RouteCode"), "ShopType",
        F.when(meets, F.col("_base")).alias("TotalOutletVP"),
        F.when(~by_route, F.col("_active")).alias("ActiveOutletVP"),
        *[F.when(by_route, brands[n]).alias(n) for n in BRAND_COUNTS],
    )
    alone = F.struct(
        day, F.col("Branch").alias("BranchCode"), F.lit("").alias("RouteCode"),
        F.lit(None).cast("string").alias("ShopType"), F.col("_base").alias("TotalOutletVP"),
        F.lit(0).cast("bigint").alias("ActiveOutletVP"), *[nothing.alias(n) for n in BRAND_COUNTS],
    )
    shop_known = F.col("ShopType").isNotNull()
    return counts.select(F.inline(F.array_compact(F.array(
        F.when(bought & (by_route | shop_known), sold),
        F.when(based & ~meets & shop_known, alone),
    ))))


def active_outlets(
    invoice: DataFrame, plan: DataFrame, reason: DataFrame, channel: DataFrame, config: DataFrame,
    material: DataFrame | None, customer: DataFrame, group: DataFrame, route: DataFrame, location: DataFrame, *,
    as_of: date | None = None, months: int | None = 0, rules: Rules = DEFAULT_RULES, tasks: int | None = None,
    dealt: tuple[str, ...] = (), plan_dealt: tuple[str, ...] = (), shops: str | None = None, buys: str | None = None,
) -> DataFrame:
    """Outlet counts per month, branch, route and shop type.

    The many groupings of a buyer and month share a task, and Spark gives it as much as fits its advisory size. ``tasks`` deals
    buyers to a number of tasks that grows with the input, which bounds the memory of each. ``material=None`` says that the lines
    carry the columns of their material; ``dealt`` names columns that follow from month, route and customer, by which the lines are
    dealt, ``plan_dealt`` such of the plan. ``shops`` names a column of the plan that lists the shop types of its customer, ``buys``
    one that is true for every outlet: the others buy nothing, so no buyer meets their routes.

    Plan totals carry no shop type of a sale; like off-plan rows they keep their key but
    a key holding a NULL shows no counts, as it would meet nothing in the final join.
    """
    window = month_window(F.col("YM"), as_of, months)
    earlier = month_window(F.col("YM"), as_of, None if months is None else months + 1)
    sales = _sold(invoice.filter(window), reason, channel, config, material, customer, group, rules, dealt)
    met = plan.filter(window)
    counts = outlet_counts(
        buyer_marks(sales, route, location, rules, tasks), met if buys is None else met.filter(F.col(buys)),
        planned_outlets(plan.filter(earlier), customer, group, shops, plan_dealt).filter(window), tasks,
    )
    whole = F.lit(True)
    for key in KEYS:
        whole = whole & F.col(key).isNotNull()
    measures = ["TotalOutletVP", "ActiveOutletVP", *BRAND_COUNTS]
    return _rows(counts).groupBy(*KEYS).agg(
        *[F.sum(F.when(whole, F.col(m))).alias(m) for m in measures]
    )
