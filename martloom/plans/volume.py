"""Invoice aggregates by month: volume, bills, and bills per brand."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.plans.common import invoice_keys, keep_customers, sale_lines
from martloom.rules import DEFAULT_RULES, Rules

KEYS = [
    "HANAFlag", "DateKey", "BranchCode", "RouteCode", "Salesman", "ChannelSalesOffice",
    "CustomerCode", "DataSource", "BillType",
]
BILL_SUMS = {
    "SoldSingle": "SoldSingle", "SoldCase": "SoldCase", "SoldBaseQty": "SoldBaseQty", "SoldLitre": "SoldLitre",
    "FreeCase": "FreeCase", "FreeBaseQty": "FreeBaseQty", "FreeLitre": "FreeLitre",
    "NetItemAmt": "NetItemAmt", "VatAmt": "VatAmt", "TotalAmount": "TotalAmt", "Discount": "Discount",
}


def last_billing_days(invoice: DataFrame) -> DataFrame:
    """Newest billing day of every month of the fact.

    Lines are counted by day first, in a hash table: the maximum of a text over the lines would sort them. A plain distinct
    would not do, since Spark drops one below a maximum.
    """
    days = invoice.groupBy("YM", "DateKey").agg(F.count(F.lit(1)).alias("_lines")).filter(F.col("_lines") > 0)
    return days.groupBy("YM").agg(F.max("DateKey").alias("LastDay")).select("LastDay")


def volume_by_brand(
    invoice: DataFrame, reason: DataFrame, customer: DataFrame, material: DataFrame, *,
    as_of: date | None = None, months: int | None = 5, rules: Rules = DEFAULT_RULES,
    last_days: DataFrame | None = None,
) -> DataFrame:
    """Volume and amounts per branch, route, salesman, customer, material and brand.

    ``last_days`` (column ``LastDay``) names the last billing day of each month; the nightly
    load keeps such a table. By default it is taken from the whole fact.
    """
    days = last_billing_days(invoice) if last_days is None else last_days
    lines = sale_lines(
        invoice, reason, material, as_of, months, rules, ["BasicMaterial", "BrandDesc", "MatType1"]
    ).join(days, F.col("DateKey") == F.col("LastDay"), "left")

    def on_last_day(measure: str):
        return F.when(F.col("LastDay").isNotNull(), F.col(measure)).otherwise(F.lit(0))

    measures = {
        "SoldSingle": F.col("SoldSingle"), "SoldCase": F.col("SoldCase"),
        "SoldCaseLastDay": on_last_day("SoldCase"), "SoldBaseQty": F.col("SoldBaseQty"),
        "SoldLitre": F.col("SoldLitre"), "FreeSingle": F.col("FreeSingle"), "FreeCase": F.col("FreeCase"),
        "FreeCaseLastDay": on_last_day("FreeCase"), "FreeBaseQty": F.col("FreeBaseQty"),
        "FreeLitre": F.col("FreeLitre"), "NetItemAmt": F.col("NetItemAmt"), "VatAmt": F.col("VatAmt"),
        "TotalAmount": F.col("TotalAmt"), "Discount": F.col("Discount"),
    }
    totals = lines.groupBy(
        *invoice_keys(), "BasicMaterial", "BrandDesc", rules.bucket(F.col("BrandDesc")).alias("Brand"), "MatType1"
    ).agg(*[F.sum(expr).alias(name) for name, expr in measures.items()])
    keys = KEYS[:-1] + ["BasicMaterial", "BrandDesc", "Brand", "MatType1", "BillType"]
    return keep_customers(totals, customer, rules, keys, [], list(measures))


def volume_totals(
    invoice: DataFrame, reason: DataFrame, customer: DataFrame, material: DataFrame | None, *,
    as_of: date | None = None, months: int | None = 5, rules: Rules = DEFAULT_RULES,
    last_days: DataFrame | None = None, dealt: tuple[str, ...] = (),
) -> DataFrame:
    """Five measures of ``volume_by_brand`` per month, branch, route, channel, customer and brand bucket.

    ``dealt`` names columns that follow from month, route and customer and by which the lines are dealt: they are then added up in place.
    """
    days = last_billing_days(invoice) if last_days is None else last_days
    lines = sale_lines(invoice, reason, material, as_of, months, rules, ["BrandDesc"]).join(
        days, F.col("DateKey") == F.col("LastDay"), "left")
    measures = {
        "SoldCase": F.col("SoldCase"),
        "SoldCaseLastDay": F.when(F.col("LastDay").isNotNull(), F.col("SoldCase")).otherwise(F.lit(0)),
        "SoldLitre": F.col("SoldLitre"), "NetItemAmt": F.col("NetItemAmt"), "TotalAmount": F.col("TotalAmt"),
    }
    keys = ["HANAFlag", "DateKey", "BranchCode", "RouteCode", "ChannelSalesOffice", "CustomerCode"]
    totals = lines.groupBy(
        *dealt, *_named(keys), rules.bucket(F.col("BrandDesc")).alias("Brand")
    ).agg(*[F.sum(expr).alias(name) for name, expr in measures.items()])
    return keep_customers(totals, customer, rules, [*keys, "Brand"], [], list(measures))


def _named(keys: list[str]) -> list[Column]:
    return [expr for name, expr in zip(KEYS, invoice_keys(), strict=True) if name in keys]


def bill_totals(
    invoice: DataFrame, reason: DataFrame, customer: DataFrame, material: DataFrame | None, *,
    as_of: date | None = None, months: int | None = 5, rules: Rules = DEFAULT_RULES, dealt: tuple[str, ...] = (),
) -> DataFrame:
    """The four counts of ``bills`` per month, branch, route, channel and customer.

    Lines become pairs, pairs bills and bills counts; where the lines are dealt by ``dealt`` (see ``volume_totals``) all three in place.
    """
    lines = sale_lines(invoice, reason, material, as_of, months, rules, ["BasicMaterial"])
    document = F.col("Documents")
    pairs = lines.groupBy(
        *dealt, *invoice_keys(), F.coalesce(document, F.lit("")).alias("_bill"), F.coalesce("BasicMaterial", F.lit("")).alias("_item")
    ).agg(F.max(document.isNotNull().cast("int")).alias("_billed"))
    sold = pairs.groupBy(*dealt, *KEYS, "_bill").agg(
        F.max("_billed").alias("NoOfBill"), F.count(F.lit(1)).alias("NoOfBrand"))
    split = sold.select(*dealt, *KEYS, *_split_by_bill_type("NoOfBill", rules), *_split_by_bill_type("NoOfBrand", rules))
    keys = ["HANAFlag", "DateKey", "BranchCode", "RouteCode", "ChannelSalesOffice", "CustomerCode"]
    counts = ["NoOfBill", "NoOfBillCN", "NoOfBrand", "NoOfBrandCN"]
    totals = split.groupBy(*dealt, *keys).agg(*[F.sum(c).alias(c) for c in counts])
    return keep_customers(totals, customer, rules, keys, counts, [])


def _split_by_bill_type(column: str, rules: Rules):
    """A count under its own name for tax invoices and under ``...CN`` for all other types."""
    bill = F.col("BillType")
    return [
        F.when(bill == rules.tax_bill, F.col(column)).otherwise(F.lit(0)).alias(column),
        F.when(bill != rules.tax_bill, F.col(column)).otherwise(F.lit(0)).alias(f"{column}CN"),
    ]


def bills(
    invoice: DataFrame, reason: DataFrame, customer: DataFrame, material: DataFrame, *,
    as_of: date | None = None, months: int | None = 5, rules: Rules = DEFAULT_RULES,
    text_pairs: bool = False,
) -> DataFrame:
    """Bills and (material, bill) pairs per customer, split by bill type.

    The lines cross the network once, combined map-side into one row per bill that lists its materials (no more than the
    material dimension has). Counts of bills and pairs are then plain sums over bills: no count multiplies rows.
    ``text_pairs`` counts the concatenated text instead, where ``1+23`` equals ``12+3``. Such a pair can span bills, so each
    bill becomes one row per material, of which the first is marked and alone carries the bill and its amounts.
    """
    lines = sale_lines(invoice, reason, material, as_of, months, rules, ["BasicMaterial"])
    document = F.col("Documents")
    sold = lines.groupBy(*invoice_keys(), F.coalesce(document, F.lit("")).alias("_bill")).agg(
        F.max(document.isNotNull()).cast("int").alias("_billed"),
        F.collect_set(F.coalesce("BasicMaterial", F.lit(""))).alias("_items"),
        *[F.sum(src).alias(name) for name, src in BILL_SUMS.items()],
    )
    sums = [F.sum(name).alias(name) for name in BILL_SUMS]
    if text_pairs:
        of_bill = ["_billed", *BILL_SUMS]
        marked = sold.select("*", F.posexplode("_items").alias("_at", "_item"))
        pairs = marked.groupBy(*KEYS, F.concat("_item", "_bill").alias("_pair")).agg(
            *[F.sum(F.when(F.col("_at") == 0, F.col(c))).alias(c) for c in of_bill])
        totals = pairs.groupBy(*KEYS).agg(
            F.coalesce(F.sum("_billed"), F.lit(0)).alias("NoOfBill"), F.count(F.lit(1)).alias("NoOfBrand"), *sums)
    else:
        totals = sold.groupBy(*KEYS).agg(
            F.sum("_billed").alias("NoOfBill"), F.sum(F.size("_items")).alias("NoOfBrand"), *sums)
    split = totals.select(
        *KEYS, *_split_by_bill_type("NoOfBill", rules), *_split_by_bill_type("NoOfBrand", rules), *BILL_SUMS
    )
    counts = ["NoOfBill", "NoOfBillCN", "NoOfBrand", "NoOfBrandCN"]
    return keep_customers(split, customer, rules, KEYS, counts, list(BILL_SUMS))


def bills_by_brand(
    invoice: DataFrame, reason: DataFrame, customer: DataFrame, material: DataFrame, *,
    as_of: date | None = None, months: int | None = 5, rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """Bills per brand bucket, split by bill type; ``months=None`` is the check version."""
    lines = sale_lines(invoice, reason, material, as_of, months, rules, ["BrandDescription", "BrandDesc"])
    keys = KEYS + ["BrandDescription", "Brand"]
    totals = lines.groupBy(
        *invoice_keys(), "BrandDescription", rules.bucket(F.col("BrandDesc")).alias("Brand")
    ).agg(
        F.count_distinct("Documents").alias("NoOfBrandBill"),
        *[F.sum(src).alias(name) for name, src in BILL_SUMS.items()],
    )
    split = totals.select(*keys, *_split_by_bill_type("NoOfBrandBill", rules), *BILL_SUMS)
    return keep_customers(split, customer, rules, keys, ["NoOfBrandBill", "NoOfBrandBillCN"], list(BILL_SUMS))
