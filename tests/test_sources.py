from __future__ import annotations

import json

import pytest

from martloom.operators import assign_region
from martloom.plans import facts
from martloom.plans.mirror import MIRRORS, mirror
from martloom.schemas import columns, schema
from martloom.sinks import JdbcSink
from martloom.sources import JdbcSource, has_rows, read_boundary, read_landing, read_sheets, read_table, split_landing


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_landing_types_and_blanks(spark, tmp_path):
    put(tmp_path / "r" / "a.csv", ",".join(columns("DimRouteExcel")) + "\nr1,ก,PS,,10,R, 7 ,s,t,d,202401\n"
        "r2,T,CS,x,11,R,oops,s,t,d,202402\n")
    rows = read_landing(spark, str(tmp_path / "r"), "DimRouteExcel", bad_cells="null").orderBy("Route").collect()
    assert rows[0]["SubBranch"] == 7 and rows[0]["SalesType2"] is None and rows[0]["TerritoryDistrict"] == "ก"
    assert rows[1]["SubBranch"] is None and rows[1]["YM"] == 202402
    with pytest.raises(Exception, match="bad cell in SubBranch"):
        read_landing(spark, str(tmp_path / "r"), "DimRouteExcel").collect()


def test_landing_wrong_shape_fails(spark, tmp_path):
    put(tmp_path / "s" / "a.csv", "Salesman,SalesmanDesc,SalesmanDescription\nx,y\n")
    with pytest.raises(Exception):
        read_landing(spark, str(tmp_path / "s"), "DimSalesmanExcel").collect()


def test_split_landing_loses_no_row(spark, tmp_path):
    head = ",".join(columns("DimRouteExcel"))
    put(tmp_path / "r" / "a.csv", head + "\nr1,T,PS,,10,R, 7 ,s,t,d,202401\nr2,T,CS,x,11,R,oops,s,t,d,never\nr3,T\n")
    put(tmp_path / "r" / "b.csv", head + "\nr4,T,CS,x,11,R,8,s,t,d,202402,more\nr5,T,CS,x,11,R,,s,t,d,202402\n")
    good, rejected = split_landing(spark, str(tmp_path / "r"), "DimRouteExcel")
    assert good.columns == columns("DimRouteExcel")
    assert {(r["Route"], r["SubBranch"], r["YM"]) for r in good.collect()} == {("r1", 7, 202401), ("r5", None, 202402)}
    told = rejected.collect()
    assert {(r["Column"], r["Cell"]) for r in told if r["Column"]} == {("SubBranch", "oops"), ("YM", "never")}
    assert sorted(r["Row"] for r in told if not r["Column"]) == ["r3,T", "r4,T,CS,x,11,R,8,s,t,d,202402,more"]
    assert all('"r2"' in r["Row"] and r["File"].endswith("a.csv") for r in told if r["Column"])
    spark.read.csv(str(tmp_path / "r" / "a.csv"), header=True).limit(2).write.parquet(str(tmp_path / "p"))
    good, rejected = split_landing(spark, str(tmp_path / "p"), "DimRouteExcel", "parquet")
    assert good.count() == 1 and {r["Cell"] for r in rejected.collect()} == {"oops", "never"}


def test_empty_guard(spark, tmp_path):
    put(tmp_path / "e" / "a.csv", "Salesman,SalesmanDesc,SalesmanDescription\n")
    assert not has_rows(read_landing(spark, str(tmp_path / "e"), "DimSalesmanExcel"))


def test_named_sheets_append(spark, tmp_path):
    head = ",".join(columns("TargetSheet"))
    put(tmp_path / "Est" / "a.csv", head + "\nAnn,1,FSR,2024-01-15,Est,Volume,10,12.5\n")
    put(tmp_path / "Other Brand" / "a.csv", head + "\nBob,2,FSR,2024-02-01 00:00:00,Other,Volume,nan,7\n")
    sheets = read_sheets(spark, str(tmp_path), ["Est", "Other Brand"])
    assert {r["Sheet"] for r in sheets.collect()} == {"Est", "Other Brand"}
    got = {r["TDMName"]: (r["YM"], r["LY"], float(r["AOP"])) for r in facts.manager_targets(sheets).collect()}
    assert got["Ann"][0] == "202401" and got["Bob"] == ("202402", None, 7.0)


def test_parquet_and_table_scans(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "p"))
    assert read_table(spark, str(tmp_path / "p")).count() == 3
    read_table(spark, str(tmp_path / "p")).createOrReplaceTempView("scan_me")
    assert read_table(spark, "scan_me", "table").count() == 3


def test_boundary_lines(spark, tmp_path):
    def feature(i, kind, coordinates):
        return json.dumps({"type": "Feature", "properties": {"id": i, "t_name_e": f"name {i}"},
                           "geometry": {"type": kind, "coordinates": coordinates}})
    square = [[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]
    far = [[5, 5], [6, 5], [6, 6], [5, 6], [5, 5]]
    put(tmp_path / "b" / "x.json", feature("1", "Polygon", [square]) + "\n"
        + feature("2", "MultiPolygon", [[far], [[[x + 3, y] for x, y in far]]]))
    edges = read_boundary(spark, str(tmp_path / "b"))
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 5.5, 5.5), (3, 8.5, 5.5), (4, 7.0, 7.0)], "n int, x double, y double")
    got = {r["n"]: r["t_name_e"] for r in assign_region(points, edges, "x", "y", ["t_name_e"], cell=0.5).collect()}
    assert got == {1: "name 1", 2: "name 2", 3: "name 2", 4: None}


def test_jdbc_options():
    source = JdbcSource("jdbc:x://host/db", user="u", password="p", driver="d")
    ranged = source.ranged_options("id", "0", "100", 8, query="WITH x AS (SELECT 1) SELECT * FROM t")
    assert ranged["dbtable"] == "(WITH x AS (SELECT 1) SELECT * FROM t) t" and ranged["numPartitions"] == "8" and ranged["fetchsize"] == "10000"
    assert source.ranged_options("id", "0", "1", 2, table="t")["dbtable"] == "t"
    sink = JdbcSink(source, batch_size=5000).options("t")
    assert sink["batchsize"] == "5000" and sink["isolationLevel"] == "NONE" and "fetchsize" not in sink
    assert JdbcSink(source).options("t", truncate=True)["truncate"] == "true"


def test_mirror_columns(spark):
    assert len(MIRRORS) == 10
    short = spark.createDataFrame([("s", "d", "e")], "Salesman string, SalesmanDesc string, SalesmanDescription string")
    assert mirror(short, "DimSalesman").first()["ETLLoadData"] is None
    assert mirror(short, "DimSalesman").columns == columns("DimSalesman")
    with pytest.raises(ValueError):
        mirror(short, "FactAOP")
    assert schema("DimMaterial")["CubeConvert"].dataType.simpleString() == "decimal(18,4)"
