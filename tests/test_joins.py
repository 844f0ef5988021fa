from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from martloom.operators import matched_flag, month_latest, or_join, recon, replace_keys, replace_window
from tests import traps


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("seed", [1, 2])
def test_or_join_equals_the_or_condition(spark, seed):
    rnd = random.Random(seed)
    code = lambda: rnd.choice(["a", "b", "c", "d", "e", None])
    left = spark.createDataFrame([(i % 20, code(), code()) for i in range(60)], "n int, k1 string, k2 string")
    right = spark.createDataFrame([(rnd.choice(["a", "b", "b", "c", None]), i) for i in range(9)], "k string, w int")
    got = or_join(left, right, ["k1", "k2"], "k")
    want = left.join(right, F.expr("k = k1 OR k = k2"), "left").drop("k")
    assert traps.canonical([tuple(r) for r in got.collect()], got.columns) == traps.canonical(
        [tuple(r) for r in want.collect()], want.columns)
    assert "NestedLoop" not in plan_of(got) and "NestedLoop" in plan_of(want)


def test_month_latest(spark):
    df = spark.createDataFrame([(1, 202401), (2, 202402), (3, 202402), (4, None)], "n int, YM int")
    assert sorted(r["n"] for r in month_latest(df).collect()) == [2, 3]


def test_matched_flag(spark):
    df = spark.createDataFrame([(True, True), (True, False), (False, True)], "a boolean, b boolean")
    got = [r[0] for r in df.select(matched_flag(F.col("a"), F.col("b"))).collect()]
    assert got == ["both", "left_only", "right_only"]


def test_recon(spark):
    a = spark.createDataFrame([("x", 1, 5), (None, 1, 7), ("same", 1, 1)], "k string, n int, m int")
    b = spark.createDataFrame([("x", 1, 4), (None, 1, 7), ("same", 1, 1), ("new", 1, 2)], "k string, n int, m int")
    got = {r["k"]: (r["mDelta"], r["Presence"]) for r in recon(a, b, ["k"], ["m"]).collect()}
    assert got == {"x": (1, "both"), "new": (-2, "right_only")}
    assert recon(a, a, ["k"], ["m"]).isEmpty()


def test_replace_frames(spark):
    old = spark.createDataFrame([("1", "a"), ("2", "b"), (None, "n")], "k string, v string")
    new = spark.createDataFrame([("2", "B"), ("3", "C")], "k string, v string")
    assert sorted(map(str, (r["v"] for r in replace_keys(old, new, ["k"]).collect()))) == ["B", "C", "a", "n"]
    kept = replace_window(old, new, F.col("k") >= "2")
    assert sorted(r["v"] for r in kept.collect()) == ["B", "C", "a", "n"]
