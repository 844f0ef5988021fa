"""Components against union-find, and how often a round reads its links."""

from __future__ import annotations

import random

from martloom.llm import components as module
from martloom.llm.common import stored


def smallest_reachable(pairs):
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for a, b in pairs:
        if a is not None and b is not None and a != b:
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
    return {(x, top(x)) for x in up}


def test_components_and_reads_of_a_round(spark, monkeypatch):
    r = random.Random(5)
    pairs = [(r.randrange(400), r.randrange(400)) for _ in range(180)] + [(None, 3), (5, 5), (7, None)]
    pairs += [(i, i + 1) for i in range(1000, 1100)] + [(2000, 2000 + i) for i in range(1, 200)]
    reads = []

    def spied(df, what):
        reads.append(df._jdf.queryExecution().optimizedPlan().toString().count("Relation ["))
        return stored(df, what)
    monkeypatch.setattr(module, "stored", spied)
    got = [tuple(x) for x in module.components(spark.createDataFrame(pairs, "u BIGINT, v BIGINT")).collect()]
    assert len(got) == len(set(got)) and set(got) == smallest_reachable(pairs)
    assert 0 < max(reads[1:]) <= 4
