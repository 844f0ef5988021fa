"""Ranked search: the SQL on the test tables, brute force on awkward rows, bounds that never undercut a score."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np

from martloom.llm import lexical, registry
from tests.llm.conftest import awkward_rows

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs, queries, top=10):
    terms = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in docs]
    terms = [(i, Counter(t)) for i, t in terms if t]
    n, whole = len(terms), sum(sum(t.values()) for _, t in terms)
    df = Counter(w for _, t in terms for w in t)
    out = []
    for item, text in queries:
        asked = TERM.findall((text or "").translate(LOWER))
        scored = []
        for doc, t in terms:
            m = 25 + (75 * sum(t.values()) * n) // whole
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10 ** 9 * t[w]) // (1000 * t[w] + 8 * m))
                    for w in asked if w in t)
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:top], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


QUERIES = [(1, "the river stone walks"), (2, None), (3, ""), (4, "!!! --"), (5, "THE the The word"), (6, "nosuchterm qqq"),
           (None, "straße été"), (7, "x x y"), (7, "light again"), (7, "light again"), (8, "123 endoftext \x1c")]


def test_search_equals_brute_force(spark, awkward, nothing):
    docs = [(r[0], r[1]) for r in awkward_rows()]
    queries = spark.createDataFrame(QUERIES, "item_id BIGINT, text STRING").withColumnRenamed("item_id", "item_id")
    want = brute(docs, sorted(set(QUERIES), key=str))
    assert rows(lexical.search(awkward.repartition(7), queries)) == want and len(want) > 20
    small = lexical.Ranking(block_bytes=20)  # a block for nearly every query
    assert rows(lexical.search(awkward, queries, small)) == want
    assert lexical.search(nothing, queries).collect() == []
    assert lexical.search(awkward, queries.filter("false")).collect() == []


def test_search_equals_sql(spark, duck, sf_dir):
    df = registry.queries()["op11_lexical_search"](spark, sf_dir)
    names, want = duck(lexical.SQL, sf_dir)
    assert sorted(names) == sorted(df.columns)
    assert rows(df) == sorted((tuple(r[names.index(c)] for c in ("item_id", "rank", "doc_id", "score")) for r in want), key=str)


def test_bounds_never_undercut_scores(spark, awkward):
    """Also with signatures so narrow that most bits are set."""
    docs = awkward.select("doc_id", "text")
    pages = lexical.index(docs, "doc_id", "text").collect()
    size = sum(len(p["ids"]) for p in pages), sum(sum(p["lengths"]) for p in pages)
    block = lexical.prepared([q for q in QUERIES if q[1]], docs, "text", size, lexical.Ranking())
    texts = {}
    for r in docs.collect():
        texts.setdefault(r["doc_id"], set()).add(r["text"])
    seen = 0
    for page in pages:
        full = dict(page.asDict(), slices=np.full(len(page["slices"]), 255, np.uint8).tobytes())
        for one in (page.asDict(), full):
            bounds = block.bounds(one)
            for i, doc in enumerate(one["ids"]):
                for text in texts[doc]:
                    n = sum(lexical.term_counts(text).values())
                    if n == one["lengths"][i]:
                        scores = block.scores(text, list(range(len(block.names))))
                        assert all(b >= s for b, s in zip(bounds[:, i].tolist(), scores))
                        seen += sum(s > 0 for s in scores)
    assert seen > 20
