from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest

from martloom.plans import dims, facts
from martloom.schemas import columns, schema
from tests.test_geo import SHAPES, boundary


def test_customer_geocoding_drops_rows_without_a_point(spark):
    names = list(dims.REGION_COLUMNS)
    shapes = boundary(spark, SHAPES)
    shapes = shapes.selectExpr("id", "rings", *[f"name AS {n}" for n in names])
    old = spark.createDataFrame([("1", "Ann", "1.5", "2.5"), ("2", None, "bad", "2")],
                                "Customer string, CustomerDesc string, LONGITUDE string, LATITUDE string")
    new = spark.createDataFrame([("1", "12.0", "1.0"), ("3", "100.0", "50.0"), ("4", "1.0", "95.0")],
                                "Customer string, LONGITUDE string, LATITUDE string")
    got = {(r["HANAFlag"], r["Customer"]): r for r in dims.customers(old, new, shapes, cell=2.0).collect()}
    assert set(got) == {(0, "1"), (1, "1"), (1, "3")}
    assert got[0, "1"]["PointTambonEN"] == "HOLED" and got[0, "1"]["CustomerDescription"] == "1 - Ann"
    assert got[1, "1"]["PointRegion"] == "TRIANGLE" and got[1, "3"]["PointRegion"] is None
    kept = dims.customers(old, new, shapes, cell=2.0, keep_ungeocoded=True)
    assert kept.count() == 5 and kept.schema.simpleString() == schema("DimCustomer").simpleString()


def test_salesmen(spark):
    sheet = spark.createDataFrame([("1", "sheet", None), ("2", None, None)],
                                  "Salesman string, SalesmanDesc string, SalesmanDescription string")
    stage = spark.createDataFrame([("2", "stage", "s2"), ("3", "stage", "s3")],
                                  "Salesman string, SalesmanDesc string, SalesmanDescription string")
    got = sorted(tuple(r) for r in dims.salesmen(sheet, stage).collect())
    assert got == [("1", "sheet", None), ("2", "stage", "s2"), ("3", "stage", "s3")]


def test_locations_match_new_or_old_code(spark):
    names = list(dims.REGION_COLUMNS)
    shapes = boundary(spark, SHAPES).selectExpr("id", "rings", *[f"name AS {n}" for n in names])
    stage = spark.createDataFrame(
        [("b1", "b1", 1.0, 1.0), ("b2", "o2", None, None), ("b3", None, 12.0, 1.0), ("b4", "o4", 1.0, 1.0)],
        "BranchCode string, OldBranchCode string, Longitude double, Latitude double")
    sheet = spark.createDataFrame(
        [(" b1 ", "w1", "A", "L", 1), ("o2", "w2", None, "L", 0), ("b2", "w3", "B", "L", 0), (None, "w9", "C", "L", 0)],
        "BranchCode string, Warehouse string, RegionSale_Label string, League string, PxIncludeFlag int")
    rows = [(r["BranchCode"], r["Warehouse"], r["RegionSale_Label"], r["PointRegion"])
            for r in dims.locations(stage, sheet, shapes, cell=1.0).collect()]
    assert sorted(rows, key=str) == sorted([
        ("b1", "w1", "0A", "HOLED"), ("b2", "w2", "0", None), ("b2", "w3", "0B", None),
        ("b3", "", "0", "TRIANGLE"), ("b4", "", "0", "HOLED")], key=str)


def test_invoices_zero_pack_and_spelling(spark):
    kinds = {f.name: f.dataType for f in schema("FactAllDataInvoice").fields}
    made = {"HANAFlag", "DateKey", "SoldCase", "FreeCase"}
    names = [c for c in columns("FactAllDataInvoice") if c not in made]
    def line(material, qty, loaded):
        values = {"Material": material, "SoldBaseQty": Decimal(qty), "FreeBaseQty": Decimal(1),
                  "BillingDate": datetime(2024, 1, 31), "ETLLoadData": loaded}
        return tuple(values.get(c) for c in names)
    ddl = ", ".join(f"{c} {kinds[c].simpleString()}" for c in names)
    stage = spark.createDataFrame([line("M1 ", 6, datetime(2024, 2, 1)), line("zero", 6, datetime(2024, 2, 1)),
                                   line("none", 6, datetime(2024, 2, 1)), line("m1", 6, datetime(2024, 1, 1))], ddl)
    packs = spark.createDataFrame([("m1", Decimal(4)), ("zero", Decimal(0))],
                                  "Material string, CubeConvert decimal(18,4)")
    rows = facts.invoices(stage, packs, as_of=date(2024, 2, 5)).collect()
    got = {r["Material"]: r["SoldCase"] for r in rows}
    assert got == {"M1 ": Decimal("1.5000"), "zero": None, "none": None}
    assert {r["DateKey"] for r in rows} == {"20240131"} and rows[0].asDict().keys() == kinds.keys()
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        facts.invoices(stage, packs, as_of=date(2024, 2, 5), strict=True).collect()


def test_calendar(spark):
    stage = spark.createDataFrame([("20240101", date(2024, 1, 1)), ("20240102", date(2024, 1, 2))],
                                  "DateID string, DateRef date")
    sheet = spark.createDataFrame([(date(2024, 1, 2), 1)], "DATE date, IS_WORKDAY int")
    got = {r["DateKey"]: r["WorkDayFlag"] for r in dims.billing_calendar(stage, sheet).collect()}
    assert got == {"20240101": None, "20240102": 1}
