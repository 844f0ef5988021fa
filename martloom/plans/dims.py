"""Dimension jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom import schemas
from martloom.functions import concat_blank, parse_number, trimmed
from martloom.operators.geo import assign_region, valid_point
from martloom.operators.joins import month_latest, or_join

# Boundary attribute -> dimension column.
REGION_COLUMNS = {
    "s_region": "PointRegion", "p_name_t": "PointProvinceTH", "p_name_e": "PointProvinceEN",
    "a_name_t": "PointAmphoeTH", "a_name_e": "PointAmphoeEN",
    "t_name_t": "PointTambonTH", "t_name_e": "PointTambonEN",
}
CALENDAR_RENAMES = {"DateID": "DateKey", "IS_WORKDAY": "WorkDayFlag"}


def stamped(df: DataFrame) -> DataFrame:
    """Add the job time. Applied at the sink, so plans stay deterministic."""
    return df.withColumn("PYLoadDate", F.current_timestamp())


def copy_table(df: DataFrame, table: str) -> DataFrame:
    """The declared columns of a table, in order (channel, groups, promotion, reason, material...)."""
    return df.select(*schemas.columns(table))


def enforce_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """Ordered columns with declared types; unparseable cells become NULL."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in target.fields])


def customer_union(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new customer systems in one frame, told apart by ``HANAFlag``."""
    wanted = [c for c in schemas.columns("DimCustomer") if c not in REGION_COLUMNS.values()]
    types = {f.name: f.dataType for f in schemas.schema("DimCustomer").fields}
    # Coordinates arrive as text and are parsed once, for both systems alike.
    types |= {"LONGITUDE": T.StringType(), "LATITUDE": T.StringType()}
    legacy = old.withColumns({
        "HANAFlag": F.lit(0), "OldCustomer": F.lit(""),
        "CustomerDescription": concat_blank(F.col("Customer"), F.lit(" - "), F.col("CustomerDesc")),
    })
    current = new.withColumn("HANAFlag", F.lit(1))

    def padded(df: DataFrame) -> DataFrame:
        return df.select(*[
            (F.col(c) if c in df.columns else F.lit(None)).try_cast(types[c]).alias(c) for c in wanted
        ])
    return padded(legacy).unionByName(padded(current))


def customers(
    old: DataFrame, new: DataFrame, boundary: DataFrame, *, cell: float = 0.25,
    keep_ungeocoded: bool = False, edges: str = "half_open", salts: int = 1,
) -> DataFrame:
    """Customer dimension with the sub-district that holds each customer."""
    both = customer_union(old, new).withColumns({
        "LONGITUDE": parse_number(F.col("LONGITUDE")), "LATITUDE": parse_number(F.col("LATITUDE")),
    })
    if not keep_ungeocoded:
        both = both.filter(valid_point(F.col("LONGITUDE"), F.col("LATITUDE")))
    placed = assign_region(
        both, boundary, "LONGITUDE", "LATITUDE", list(REGION_COLUMNS), cell=cell, edges=edges, salts=salts
    ).withColumnsRenamed(REGION_COLUMNS)
    return enforce_schema(placed, schemas.schema("DimCustomer"))


def locations(
    stage: DataFrame, sheet: DataFrame, boundary: DataFrame, *, cell: float = 0.25,
    edges: str = "half_open", keep_ungeocoded: bool = True, salts: int = 1,
) -> DataFrame:
    """Branch dimension: region by coordinates, labels from a sheet keyed by new or old code."""
    if not keep_ungeocoded:
        stage = stage.filter(valid_point(F.col("Longitude"), F.col("Latitude")))
    placed = assign_region(
        stage, boundary, "Longitude", "Latitude", list(REGION_COLUMNS), cell=cell, edges=edges, salts=salts
    ).withColumnsRenamed(REGION_COLUMNS).withColumns({
        "BranchCode": F.col("BranchCode").cast("string"), "OldBranchCode": F.col("OldBranchCode").cast("string"),
    })
    labels = sheet.select(
        trimmed(F.col("BranchCode")).alias("_sheet_code"), "Warehouse", "RegionSale_Label", "League", "PxIncludeFlag"
    )
    return (
        or_join(placed, labels, ["BranchCode", "OldBranchCode"], "_sheet_code")
        .fillna({"Warehouse": "", "RegionSale_Label": ""})
        .withColumn("RegionSale_Label", F.concat(F.lit("0"), F.col("RegionSale_Label")))
    )


def routes(sheet: DataFrame, stage: DataFrame) -> DataFrame:
    """Route dimension: newest month of the sheet with the staged route names."""
    latest = month_latest(sheet).select(
        "Route", "TerritoryDistrict", "SalesType1", "SalesType2", "BranchVL", "RegionSSC", "SubBranch"
    ).distinct()
    names = stage.select("Route", "RouteDesc", "RouteDescription", "Sector", "ETLLoadData")
    return latest.join(names, "Route", "left").dropDuplicates()


def route_salesmen(sheet: DataFrame, stage: DataFrame) -> DataFrame:
    """Who worked which route, for every month of the sheet."""
    people = sheet.select("Route", "BranchVL", "SalesMan", "TDM", "DM", "YM")
    return people.join(stage.select("Route", "ETLLoadData"), "Route", "left").dropDuplicates()


def salesmen(sheet: DataFrame, stage: DataFrame) -> DataFrame:
    """Salesmen of the sheet and of the stage; the sheet's text wins where it has any."""
    texts = ["SalesmanDesc", "SalesmanDescription"]
    ex = sheet.select("Salesman", *[F.col(c).alias(f"_ex_{c}") for c in texts])
    return ex.join(stage.select("Salesman", *texts), "Salesman", "full").select(
        "Salesman", *[F.coalesce(f"_ex_{c}", c).alias(c) for c in texts]
    )


def billing_calendar(stage: DataFrame, workdays: DataFrame) -> DataFrame:
    """Calendar with the workday flag of the sheet."""
    days = workdays.select(F.col("DATE").alias("_day"), "IS_WORKDAY")
    return stage.join(days, F.col("DateRef") == F.col("_day"), "left").drop("_day").withColumnsRenamed(
        CALENDAR_RENAMES
    )
