"""A small mart full of awkward rows, for Spark and for DuckDB alike."""

from __future__ import annotations

import random
from datetime import datetime
from decimal import Decimal

import duckdb
import pandas as pd

SCHEMAS = {
    "d_material": "Material string, BasicMaterial string, BrandDesc string, BrandDescription string, MatType1 string, "
                  "MaterialType string, MatType1Id int, PackagingType string, GroupPostMix string, "
                  "Millilitre decimal(18,4), Litre decimal(12,4)",
    "d_customer": "HANAFlag int, Customer string, CustGrp1 int, SpecialGrp1 string, CustType string",
    "d_group": "CustGrp int, ShopType string",
    "d_channel": "ChannelMarge string, SalesOfficeDesc string",
    "d_config": "Value1 string, Value2 string",
    "d_reason": "ReasonCode string",
    "d_route": "Route string, SalesType1 string, BranchVL string",
    "d_location": "BranchCode string, PxIncludeFlag int",
    "f_plan": "YM string, Branch string, Route string, Customer string",
    "f_visit": "Branch string, Route string, Salesman string, Customer string, AssignedDate timestamp, "
               "VisitDate timestamp",
    "f_asset_plan": "YM string, BranchByAsset string, BranchByVP string, VPRoute string, Customer string, "
                    "AssetType string, AssetSubType string, AssetStatus string, ActiveStatus string",
    "f_invoice": "HANAFlag int, Branch string, YM string, DateKey string, Route string, VL string, "
                 "ChannelMarge string, BType string, Salesman string, Customer string, Documents string, "
                 "Material string, ReasonCode string, DataSource string, SoldSingle decimal(18,4), "
                 "SoldCase decimal(18,4), SoldBaseQty decimal(18,4), FreeSingle decimal(18,4), "
                 "FreeCase decimal(18,4), FreeBaseQty decimal(18,4), NetItemAmt decimal(18,4), "
                 "VatAmt decimal(18,4), TotalAmt decimal(18,4), Discount decimal(18,4)",
}
CUSTOMERS = ["1", "2", "3", "4", "5", "6", "E7", "8", None]
BRANCHES = ["10", "11", "12", None]
ROUTES = ["r1", "r2", "r3", "", None]
MONTHS = ["202412", "202501", "202502"]


def rows(seed: int, hot: bool = False) -> dict[str, list[tuple]]:
    """``hot`` puts a third of the invoice lines on one customer, bill and material."""
    rnd = random.Random(seed)
    pick = rnd.choice
    brands = ["Brand#2", "Brand#3", "Brand#1", "Brand#11", "Brand#12", "Brand#4", "Brand#19", "Brand#7", None, ""]
    t: dict[str, list[tuple]] = {}
    t["d_material"] = [
        (f"m{i}", pick(["b1", "b2", "", None]), brands[i], brands[i], pick(["T1", None]),
         "Z99" if i == 7 else "Z31", pick([1, 8]) if i else 1, pick(["NR", "RB"]), "",
         Decimal(i * 100), Decimal(i) / 10)
        for i in range(len(brands))
    ] + [("m98", "b1", "Brand#2", "Brand#2", "T1", "Z31", 3, "NR", "", Decimal(1000), Decimal(1)),
         ("m99", "b1", "Brand#2", "Brand#2", "T1", "Z31", 1, None, "PostMix", Decimal(1000), Decimal(1))]
    t["d_customer"] = [
        (1, c, 100 + i, pick(["", "Other"]), "Customer store") for i, c in enumerate(CUSTOMERS[:-1])
    ] + [(0, "1", 100, "", "Customer store"),          # other system, same code
         (1, "2", 101, "", "Customer store"),           # listed twice
         (1, "9", 131, "", "Customer store"), (1, "10", None, "Other", "Other")]
    t["d_group"] = [(100, "FSR"), (101, "Provision"), (102, "Other"), (103, "CVM"), (104, None), (105, "FSR"),
                    (106, "FSR"), (107, "Provision"), (131, "FSR")]
    t["d_channel"] = [("c1", "Direct Sales"), ("c2", "Post-Mix"), ("c3", "Elsewhere"), ("c4", "Online")]
    t["d_config"] = [("Direct Sales", "Normal"), ("Post-Mix", "Post-Mix"), ("Elsewhere", "Normal"),
                     ("Online", "Normal"), ("Online", "Post-Mix"), ("Direct Sales", "Normal")]  # listed twice
    t["d_reason"] = [("",), ("101",), ("601",), (None,)]
    t["d_route"] = [("r1", "PS", "10"), ("r2", "CS", "11"), ("r2", "PS", "12"), ("r3", None, None)]
    t["d_location"] = [("10", 0), ("11", 1), ("12", None), ("12", 1)]
    t["f_plan"] = [
        (pick(MONTHS), pick(BRANCHES), pick(ROUTES), pick(CUSTOMERS)) for _ in range(60)
    ]
    days = list(pd.date_range("2024-12-28", "2025-02-28", freq="D").to_pydatetime())
    t["f_visit"] = [
        (pick(BRANCHES), pick(ROUTES), pick(["s1", None]), pick(CUSTOMERS), pick(days), pick(days))
        for _ in range(80)
    ] + [("10", "r1", "s1", "1", datetime(2025, 1, 31), datetime(2025, 1, 31))]
    t["f_asset_plan"] = [
        (pick(MONTHS), pick(BRANCHES), pick(BRANCHES), pick(ROUTES), pick(CUSTOMERS), pick(["cooler", "rack"]),
         pick(["k1", "k2", None]), pick(["ok", None]), pick(["0", "1"])) for _ in range(60)
    ]
    lines = []
    for n in range(400):
        common = hot and n % 3 == 0
        month = pick(MONTHS)
        sold, free = Decimal(rnd.randint(1, 40)), Decimal(rnd.randint(0, 4))
        net = Decimal(rnd.randint(100, 99999)) / 100
        vat = (net * 7 / 100).quantize(Decimal("0.0001"))
        lines.append((
            1 if common else pick([1, 1, 1, 0]), pick(BRANCHES), month, month + pick(["05", "17", "28"]),
            pick(ROUTES), pick(ROUTES), pick(["c1", "c2", "c3", "c4", None]), pick(["TaxInv", "TaxInv", "CN", None]),
            pick(["s1", "s2", None]), "1" if common else pick(CUSTOMERS), "hot" if common else pick(["d1", "d2", "", None]),
            "m0" if common else f"m{rnd.randint(0, 11)}", pick(["", "", "101", "601", None]), pick(["O", "F"]),
            sold * 2, sold / 4, sold, free * 2, free / 4, free, net, vat, net + vat, Decimal(rnd.randint(0, 99)) / 10,
        ))
    t["f_invoice"] = lines
    return t


def names(table: str) -> list[str]:
    return [c.split()[0] for c in SCHEMAS[table].split(", ")]


def frames(spark, tables: dict[str, list[tuple]]):
    return {name: spark.createDataFrame(data, SCHEMAS[name]) for name, data in tables.items()}


def database(tables: dict[str, list[tuple]]):
    duck = duckdb.connect()
    kinds = {"string": "VARCHAR", "int": "INTEGER", "timestamp": "TIMESTAMP"}
    for name, data in tables.items():
        columns = [c.split() for c in SCHEMAS[name].split(", ")]
        duck.execute(f"CREATE TABLE {name} ({', '.join(f'{c} {kinds.get(k, k)}' for c, k in columns)})")
        duck.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(columns))})", data)
    return duck


def canonical(data, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if v is None or isinstance(v, (str, bool)):
            return repr(v)
        return f"{float(v):.9g}"
    return sorted(tuple(cell(row[i]) for i in order) for row in data)


def assert_same(df, duck, sql: str):
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    cursor = duck.execute(sql)
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    want = canonical(cursor.fetchall(), columns)
    assert want, "the fixture must exercise the query"
    assert got == want
