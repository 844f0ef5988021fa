from __future__ import annotations

import random

import pytest

from pyspark.sql import functions as F

from martloom.operators import assign_region, boundary_cells

SQUARE = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)]
HOLE = [(3.0, 3.0), (3.0, 6.0), (6.0, 6.0), (6.0, 3.0), (3.0, 3.0)]
TRIANGLE = [(10.0, 0.0), (20.0, 0.0), (10.0, 10.0), (10.0, 0.0)]
SHAPES = {"holed": [SQUARE, HOLE], "triangle": [TRIANGLE]}


def boundary(spark, shapes):
    rows = [(k, k.upper(), [[{"x": x, "y": y} for x, y in ring] for ring in rings]) for k, rings in shapes.items()]
    return spark.createDataFrame(rows, "id string, name string, rings array<array<struct<x:double,y:double>>>")


def even_odd(x, y, rings):
    inside = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                inside = not inside
    return inside


def assigned(spark, points, shapes, **kw):
    df = spark.createDataFrame(points, "n int, x double, y double")
    out = assign_region(df, boundary(spark, shapes), "x", "y", ["name"], **kw)
    return sorted((r["n"], r["name"] or "") for r in out.collect())


def test_edges_holes_and_missing_points(spark):
    points = [(1, 1.0, 1.0), (2, 4.0, 4.0), (3, 12.0, 2.0), (4, 19.0, 9.0), (5, None, 1.0), (6, float("nan"), 1.0),
              (7, 10.0, 5.0), (8, 500.0, 5.0), (9, 0.0, 0.0)]
    got = dict(assigned(spark, points, SHAPES, cell=1.0))
    assert got == {1: "HOLED", 2: "", 3: "TRIANGLE", 4: "", 5: "", 6: "", 7: "TRIANGLE", 8: "", 9: "HOLED"}


def test_closed_edges_match_both_sides(spark):
    got = assigned(spark, [(7, 10.0, 5.0), (2, 4.0, 3.0)], SHAPES, cell=4.0, edges="closed")
    assert got == [(2, "HOLED"), (7, "HOLED"), (7, "TRIANGLE")]


@pytest.mark.parametrize("cell,salts", [(0.1, 1), (0.7, 3), (50.0, 1)])
def test_random_polygons_against_brute_force(spark, cell, salts):
    rnd = random.Random(7)
    shapes = {}
    for i in range(4):
        ring = [(round(rnd.uniform(0, 3), 1), round(rnd.uniform(0, 3), 1)) for _ in range(9)]
        shapes[f"p{i}"] = [ring + ring[:1]]
    points = [(n, round(rnd.uniform(-0.2, 3.2), 1), round(rnd.uniform(-0.2, 3.2), 1)) for n in range(300)]
    points += [(n, 0.7, 0.7) for n in range(300, 450)]  # a crowded cell
    want = []
    for n, x, y in points:
        hits = [k.upper() for k, rings in shapes.items() if even_odd(x, y, rings)]
        want += [(n, h) for h in hits] or [(n, "")]
    assert assigned(spark, points, shapes, cell=cell, salts=salts) == sorted(want)


def test_index_grows_with_the_edges(spark):
    """A comb of many teeth in one row of cells: every cell keeps its own teeth, not all to its right."""
    teeth = 300
    ring = [(0.0, 0.0)]
    for i in range(teeth):
        ring += [(i + 0.2, 0.9), (i + 0.8, 0.1)]
    ring += [(float(teeth), 0.95), (0.0, 0.95), (0.0, 0.0)]
    index = boundary_cells(boundary(spark, {"comb": [ring]}), 1.0, ["name"])
    size = index.agg(F.sum(F.size("edges")), F.sum(F.size("heights")), F.max(F.size("edges"))).first()
    assert size[0] < 4 * len(ring) and size[1] < 3 * len(ring) and size[2] < 8
    points = [(n, n * 0.37 % (teeth + 2), n * 0.013 % 1.0) for n in range(600)]
    want = sorted((n, "COMB" if even_odd(x, y, [ring]) else "") for n, x, y in points)
    assert assigned(spark, points, {"comb": [ring]}, cell=1.0, lonlat=False) == want


def test_cells_inside_without_edges(spark):
    big = [(0.5, 0.5), (9.5, 0.5), (9.5, 9.5), (0.5, 9.5), (0.5, 0.5)]
    index = boundary_cells(boundary(spark, {"big": [big]}), 1.0, ["name"])
    assert index.filter(F.size("edges") == 0).agg(F.count(F.lit(1)), F.min("odd")).first() == (64, 1)
    extra = boundary(spark, {"big": [big]})
    points = spark.createDataFrame([(4.0, 4.0, 1, "a"), (40.0, 4.0, 2, None)], "x double, y double, edges int, odd string")
    out = assign_region(points, extra, "x", "y", ["name"], cell=1.0)
    assert sorted(map(tuple, out.collect())) == [(4.0, 4.0, 1, "a", "BIG"), (40.0, 4.0, 2, None, None)]
