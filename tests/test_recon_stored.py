"""The drill-down computes each version once, and narrow sides compare as whole ones do."""

from __future__ import annotations

from checks.registry import queries
from martloom.operators import digested, recon


def test_the_drill_reads_stored_versions(spark, sf_dir):
    found = queries()["recon_drill"](spark, sf_dir)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_digest" in plan and "l_orderkey" not in plan and "l_extendedprice" not in plan
    whole = queries()["recon_delta"](spark, sf_dir).select(found.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))


def test_narrow_sides_tell_what_whole_sides_tell(spark):
    schema = "k string, note string, n int"
    left = spark.createDataFrame([("a", "x", 1), ("b", None, 2), ("c", "x", None), (None, "x", 1), ("d", "p", 1), ("d", "q", 1)], schema)
    right = spark.createDataFrame([("a", "y", 1), ("b", None, 2), ("c", "x", 0), (None, "y", 1), ("d", "q", 1), ("d", "p", 1)], schema)
    want = recon(left, right, ["k"], ["n"])
    got = recon(*digested(left, right, ["k"], ["n"]), ["k"], ["n"]).select(want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert {r["k"] for r in got.collect()} == {"a", "c", None}
