"""Assigning points to map regions with equi joins and built-in expressions.

A boundary row is ``(id, attributes..., rings)``; ``rings`` holds every closed ring of
the region, holes included. A point is inside when an odd number of edges crosses the ray to its right. Each grid cell keeps
what that number needs: its own edges, and for all edges further right one bit for the cell, corrected at the heights at which
an edge leaves the cell's column inside the cell's row. The index grows with the edges, however many lie to the right of a cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _edges(rings: Column) -> Column:
    def ring_edges(ring: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(ring) - 1),
            lambda i: F.struct(
                F.element_at(ring, i)["x"].alias("x1"), F.element_at(ring, i)["y"].alias("y1"),
                F.element_at(ring, i + 1)["x"].alias("x2"), F.element_at(ring, i + 1)["y"].alias("y2"),
            ),
        )
    usable = F.filter(rings, lambda r: F.size(r) > 1)
    return F.flatten(F.transform(usable, ring_edges))


def boundary_cells(boundary: DataFrame, cell: float, attributes: list[str], key: str = "id") -> DataFrame:
    """One row per region and grid cell: ``key, attributes..., cx, cy, edges, heights, odd``.

    ``edges`` are those whose box meets the cell. Of the edges wholly right of the cell's column, those that a height y meets
    are odd in number when ``odd`` + the number of ``heights`` above y is odd: the ends of such edges come in pairs,
    except where an edge that crosses the column meets them. So each edge adds its right end to the columns it crosses.
    Cells without edges are listed only if they lie inside.
    """
    step = F.lit(float(cell))

    def cell_no(v: Column) -> Column:
        return F.floor(v / step)

    region = [key, *attributes]
    e = F.col("edge")
    edges = boundary.select(*region, F.explode(_edges(F.col("rings"))).alias("edge")).select(
        *region, "edge", *[f(cell_no(e[f"{axis}1"]), cell_no(e[f"{axis}2"])).alias(f"{axis}_{name}")
                           for axis in "xy" for name, f in (("lo", F.least), ("hi", F.greatest))])
    own = edges.withColumn("cx", F.explode(F.sequence("x_lo", "x_hi"))).select(
        *region, "cx", F.explode(F.sequence("y_lo", "y_hi")).alias("cy"), "edge")
    right_end = F.when(cell_no(e["x1"]) > cell_no(e["x2"]), e["y1"]).otherwise(e["y2"])
    ends = edges.filter(F.col("x_lo") < F.col("x_hi")).select(
        *region, F.explode(F.sequence(F.col("x_lo"), F.col("x_hi") - 1)).alias("cx"), right_end.alias("height")
    ).withColumn("cy", cell_no(F.col("height")))
    column = Window.partitionBy(*region, "cx").orderBy(F.desc("cy"))
    # From one row with heights down to the next one, the number of heights above stays the same.
    above = ends.groupBy(*region, "cx", "cy").agg(F.count(F.lit(1)).alias("n")).select(
        *region, "cx", "cy", F.sum("n").over(column).alias("above"), F.lead("cy").over(column).alias("next"))
    inner = above.filter((F.col("above") % 2 == 1) & F.col("next").isNotNull()).select(
        *region, "cx", F.explode(F.sequence(F.col("next"), F.col("cy") - 1)).alias("cy"), F.lit(1).alias("odd"))
    rows = own.unionByName(ends, allowMissingColumns=True).unionByName(inner, allowMissingColumns=True)
    return rows.groupBy(*region, "cx", "cy").agg(
        F.collect_list("edge").alias("edges"), F.collect_list("height").alias("heights"),
        F.coalesce(F.max("odd"), F.lit(0)).alias("odd"))


def _inside(x: Column, y: Column) -> Column:
    """Even-odd rule with half-open edges: a shared border belongs to one region."""
    crossings = F.filter(
        F.col("_edges"),
        lambda e: ((e["y1"] > y) != (e["y2"] > y))
        & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"]),
    )
    further = F.size(F.filter("_heights", lambda h: h > y)) + F.col("_odd")
    return (F.size(crossings) + further) % 2 == 1


def _on_edge(x: Column, y: Column, edges: Column) -> Column:
    return F.exists(
        edges,
        lambda e: ((e["x2"] - e["x1"]) * (y - e["y1"]) == (e["y2"] - e["y1"]) * (x - e["x1"]))
        & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
        & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])),
    )


def valid_point(x: Column, y: Column, lonlat: bool = True) -> Column:
    """True when both coordinates are numbers (and a longitude/latitude if asked)."""
    usable = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    return usable & x.between(-180, 180) & y.between(-90, 90) if lonlat else usable


def assign_region(
    points: DataFrame, boundary: DataFrame, x: str, y: str, attributes: list[str], *,
    cell: float = 0.25, key: str = "id", edges: str = "half_open", lonlat: bool = True,
    salts: int = 1,
) -> DataFrame:
    """Left join every point to the region that contains it.

    ``edges="closed"`` also matches a point lying on a border to each region that shares
    it. A region of several rows with the same attributes is one region. The cell index is shuffled once, so adaptive
    execution knows its real size before it chooses: a small index is broadcast, a large one joins by cell. Then ``salts``
    spreads a crowded cell over that many tasks; points without a cell are always spread.
    """
    index = boundary_cells(boundary, cell, attributes, key)
    index = index.select(*[F.col(c).alias(f"_{c}") for c in [*attributes, "cx", "cy", "edges", "heights", "odd"]])
    px, py = F.col(x), F.col(y)
    valid, row = valid_point(px, py, lonlat), F.xxhash64(*[F.col(c) for c in points.columns])
    spread = F.pmod(row, F.lit(salts)).cast("int") if salts > 1 else F.lit(0)
    placed = points.select(
        "*",
        F.when(valid, F.floor(px / F.lit(float(cell)))).otherwise(0).alias("_x"),
        F.when(valid, F.floor(py / F.lit(float(cell)))).otherwise(0).alias("_y"),
        # No slot of the index is negative, so points without a cell meet nothing, in many tasks.
        F.when(valid, spread).otherwise(-1 - F.pmod(row, F.lit(1 << 16)).cast("int")).alias("_salt"),
    )
    slots = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))) if salts > 1 else F.lit(0)
    index = index.withColumn("_slot", slots).repartition("_cx", "_cy", "_slot")
    hit = _inside(px, py)
    if edges == "closed":
        hit = hit | _on_edge(px, py, F.col("_edges"))
    met = placed.join(
        index,
        (F.col("_x") == F.col("_cx")) & (F.col("_y") == F.col("_cy"))
        & (F.col("_salt") == F.col("_slot")) & hit,
        "left",
    )
    return met.select(*points.columns, *[F.col(f"_{a}").alias(a) for a in attributes])
