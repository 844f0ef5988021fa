"""Phrases: the SQL on the test tables, brute force on awkward rows, and fingerprints that all collide."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from martloom.llm import collocations, registry
from martloom.llm.collocations import Rule
from tests.llm.conftest import SCHEMA, awkward_rows

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs, least, inside=80, top=2000):
    f, n = Counter(), Counter()
    for text, lang in docs:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f.update((lang, tuple(w[i: i + k])) for i in range(len(w) - k + 1))
    f = {k: v for k, v in f.items() if v >= least}
    best = {}
    for (lang, p), a in f.items():
        if len(p) > 1:
            best[lang, p] = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
    out = []
    for lang in n:
        kept = []
        for (x, p), (score, k) in best.items():
            if x == lang:
                longer = [f[lang, q] for (y, q) in best if y == lang and len(q) > len(p)
                          and any(q[i: i + len(p)] == p for i in range(len(q) - len(p) + 1))]
                if not any(100 * b >= inside * f[lang, p] for b in longer):
                    kept.append((-score, -f[lang, p], " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def rows(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


PHRASES = ["New York City is big. New  York\tCITY\nof new york, city", "a b c d e a b c d", "x!x x?x x;x x", "ein Haus\x85am See",
           "\x00 \x00 \x00", "été à la mer été à la mer"]


@pytest.fixture(scope="module")
def texts(spark):
    made = [(i, PHRASES[i % 6] + f" w{i % 11}", ("en", "de", None, "und")[i % 4], "s", None, None, None, i, None) for i in range(120)]
    return spark.createDataFrame(made, SCHEMA)


def test_phrases_equal_brute_force(spark, awkward, nothing, texts):
    both = awkward.unionByName(texts)
    want = brute([(r["text"], r["lang"]) for r in both.collect()], 5)
    assert rows(collocations.collocations(both.repartition(5), Rule(least=5))) == want and len(want) > 40
    short = brute([(r["text"], r["lang"]) for r in both.collect()], 5, top=3)
    assert rows(collocations.collocations(both, Rule(least=5, top=3))) == short
    assert collocations.collocations(nothing).collect() == []
    assert len(awkward_rows()) and rows(collocations.collocations(awkward.filter("text IS NULL"))) == []


def test_phrases_equal_sql(spark, duck, sf_dir):
    df = registry.queries()["op12_collocations"](spark, sf_dir)
    names, want = duck(collocations.SQL, sf_dir)
    assert sorted(names) == sorted(df.columns)
    order = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert rows(df) == sorted(tuple(r[names.index(c)] for c in order) for r in want)


def test_colliding_fingerprints_are_told_apart():
    """With one fingerprint for everything, phrases are still counted by their words and their language."""
    import pyarrow as pa
    chunk = collocations.Chunk(pa.array(["a b a b c", "a b", None]), ["en", "de", "en"])
    chunk.fingerprints = lambda at, length: np.zeros(len(at), np.int64)
    encoded = chunk.words.dictionary_encode()
    numbers = encoded.indices.to_numpy(zero_copy_only=False)
    pointer, many = collocations._counted(chunk, numbers, chunk.all_of(2), 2)
    spelled = encoded.dictionary.to_pylist()
    got = {(chunk.langs[chunk.of_text[p]], spelled[numbers[p]], spelled[numbers[p + 1]]): m for p, m in zip(pointer, many.tolist())}
    assert got == {("en", b"a", b"b"): 2, ("en", b"b", b"a"): 1, ("en", b"b", b"c"): 1, ("de", b"a", b"b"): 1}
