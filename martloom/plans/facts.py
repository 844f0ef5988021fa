"""Fact jobs: trailing slices, plan lookups and targets."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom import schemas
from martloom.functions import date_key, day_window, divide, fold_key, parse_number, ym
from martloom.plans.dims import enforce_schema


def invoices(
    stage: DataFrame, material: DataFrame, *, as_of: date | None = None, days: int | None = 5, strict: bool = False
) -> DataFrame:
    """Invoice lines loaded in the last ``days`` days, with cases from the pack size.

    Material codes compare without regard to case or trailing blanks. The load stamp is a
    plain column, so its filter reaches the scan.
    """
    fresh = stage if days is None else stage.filter(day_window(F.col("ETLLoadData"), as_of, days))
    packs = material.select(fold_key(F.col("Material")).alias("_pack"), "CubeConvert")
    sized = fresh.withColumn("_code", fold_key(F.col("Material"))).join(packs, F.col("_code") == F.col("_pack"), "left")
    made = {
        "HANAFlag": F.lit(1),
        "DateKey": date_key(F.col("BillingDate")),
        "SoldCase": divide(F.col("SoldBaseQty"), F.col("CubeConvert"), strict).cast("decimal(18,4)"),
        "FreeCase": divide(F.col("FreeBaseQty"), F.col("CubeConvert"), strict).cast("decimal(18,4)"),
    }
    return sized.select(*[
        made[c].alias(c) if c in made else F.col(c) for c in schemas.columns("FactAllDataInvoice")
    ])


def visit_list(stage: DataFrame, *, as_of: date | None = None, days: int | None = 1) -> DataFrame:
    fresh = stage if days is None else stage.filter(day_window(F.col("ETLLoadData"), as_of, days))
    return fresh.select(*schemas.columns("FactVisitList"))


def actual_visits(stage: DataFrame, *, as_of: date | None = None, days: int = 1) -> DataFrame:
    return stage.filter(day_window(F.col("ETLLoadData"), as_of, days)).select(*schemas.columns("FactActualVisit"))


def actual_visits_full(stage: DataFrame, *, since: str = "202110") -> DataFrame:
    """Full history from a fixed first month, written as a date bound the scan can use."""
    first = F.to_date(F.lit(f"{since}01"), "yyyyMMdd")
    return stage.filter(F.col("VisitDate") >= first).select(*schemas.columns("FactActualVisit"))


def assets(stage: DataFrame, plan: DataFrame, *, as_of: date | None = None, days: int | None = 1) -> DataFrame:
    """Assets with the planned branch and route of their customer; ``days=None`` loads all."""
    fresh = stage if days is None else stage.filter(day_window(F.col("ETLLoadData"), as_of, days))
    place = plan.select("YM", "Customer", F.col("Branch").alias("BranchByVP"), F.col("Route").alias("VPRoute"))
    return fresh.join(place, ["YM", "Customer"], "left").select(*schemas.columns("FactDataAsset"))


def customer_plan(stage: DataFrame) -> DataFrame:
    return stage.select(*schemas.columns("FactCustPerMonPlan"))


def targets(landing: DataFrame, table: str, keep_stamp: bool = False) -> DataFrame:
    """Branch or route targets of a landing, with declared types.

    ``keep_stamp`` carries the landing's load time over to the target.
    """
    if not keep_stamp:
        return enforce_schema(landing, schemas.schema(table))
    return enforce_schema(landing, schemas.schema(table).add("PYLoadDate", "timestamp"))


def manager_targets(sheets: DataFrame | list[DataFrame], table: str = "FactAOPTDM") -> DataFrame:
    """Targets per manager: sheets appended, month taken from the start date."""
    landing = sheets if isinstance(sheets, DataFrame) else reduce(DataFrame.unionByName, sheets)
    start = F.trim(F.col("StartDate").cast("string")).try_cast("date")
    return landing.select(*[
        ym(start).alias("YM") if c == "YM"
        else parse_number(F.col(c), "decimal(18,4)").alias(c) if c in ("LY", "AOP")
        else F.col(c)
        for c in schemas.columns(table)
    ])
