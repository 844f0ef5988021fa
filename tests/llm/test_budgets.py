"""Budgets of recipes with weights of 0."""

from __future__ import annotations

from martloom.llm import mixing


def test_weight_zero_leaves_its_share_to_others(spark):
    rows = [("a", "x", 1000), ("a", "y", 10), ("b", "y", 1000), ("c", "x", 500)]
    df = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "_key BIGINT, _top STRING, _low STRING, n_tokens BIGINT") \
        .selectExpr("_key", "'=' || _top AS _top", "'=' || _low AS _low", "n_tokens")
    recipe = mixing.Recipe(share=(800, 2510), epochs=1, weights={"low": {"x": 0}})
    got = {(r["_top"], r["_low"]): int(r["allot"]) for r in mixing.budgets(df, ["top", "low"], recipe).collect()}
    assert got == {("=a", "=x"): 0, ("=a", "=y"): 10, ("=b", "=y"): 790, ("=c", "=x"): 0}
    recipe = mixing.Recipe(share=(800, 2510), epochs=1, weights={"top": {"b": 0}})
    got = {(r["_top"], r["_low"]): int(r["allot"]) for r in mixing.budgets(df, ["top", "low"], recipe).collect()}
    assert got == {("=a", "=x"): 390, ("=a", "=y"): 10, ("=b", "=y"): 0, ("=c", "=x"): 400}
