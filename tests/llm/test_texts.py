"""Operators on whole texts, held against brute force."""

from __future__ import annotations

import collections
import hashlib
import math
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from martloom.llm import language_id, near_dedup, passages, quality, substrings, token_counts
from martloom.llm.common import held_out, shared_folder, table
from tests.llm.conftest import awkward_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, sf_dir):
    return [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]


# ---- passages ----

def passages_by_hand(rows, depth):
    first = {}
    order = lambda i: math.inf if i is None else i
    for i, t in rows:
        w = WORD.findall(t or "")
        for j in range(len(w) - depth + 1):
            k = tuple(w[j: j + depth])
            first[k] = min(first.get(k, math.inf), order(i))
    out = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for j in range(len(w) - depth + 1):
            if first[tuple(w[j: j + depth])] < order(i):
                gone[j: j + depth] = [True] * depth
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return collections.Counter(out)


def test_passages_awkward(spark, awkward):
    want = passages_by_hand([r[:2] for r in awkward_rows()], 13)
    assert collections.Counter(map(tuple, passages.dedup_digests(awkward).collect())) == want


def test_passages_documents(spark, sf_dir):
    got = collections.Counter(map(tuple, passages.op5_repeated_passages(spark, sf_dir).collect()))
    assert got == passages_by_hand(documents(spark, sf_dir), 13)


def test_passages_split_by_longer_prefixes(spark, awkward, monkeypatch):
    """Groups of a few suffixes: prefixes are lengthened up to the whole window, the result stays."""
    monkeypatch.setattr(passages, "GROUP_SUFFIXES", 5)
    want = passages_by_hand([r[:2] for r in awkward_rows()], 13)
    assert collections.Counter(map(tuple, passages.dedup_digests(awkward).collect())) == want


def test_passages_cut_keeps_columns_and_clean_texts(awkward):
    cut = passages.without_repeats(awkward, 13)
    assert cut.columns == awkward.columns
    rows = {(r["h"]): r["text"] for r in cut.collect()}
    before = {r[7]: r[1] for r in awkward_rows()}
    assert rows[3] is None and rows[4] == "" and rows[11] == before[11] and rows[16] == before[16]
    assert 1 not in rows  # a whole copy of a smaller document
    assert before[8].split()[:3] != rows[8].split()[:3] and rows[8].endswith(before[8][-40:])


def test_passages_empty(nothing):
    assert passages.dedup_digests(nothing).collect() == []
    assert passages.without_repeats(nothing).collect() == []


# ---- substrings ----

def substrings_by_hand(rows, length):
    count = collections.Counter()
    raws = [(i, (t or "").encode()) for i, t in rows]
    for _, b in raws:
        for j in range(len(b) - length + 1):
            count[b[j: j + length]] += 1
    out = []
    for i, b in raws:
        gone = bytearray(len(b))
        for j in range(len(b) - length + 1):
            if count[b[j: j + length]] > 1:
                gone[j: j + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return collections.Counter(out)


@pytest.mark.parametrize("length", [400, 101])
def test_substrings_awkward(awkward, length):
    want = substrings_by_hand([(r[0], r[1]) for r in awkward_rows() if r[0] != 21], length)
    some = awkward.filter("doc_id IS NULL OR doc_id <> 21")
    assert collections.Counter(map(tuple, substrings.digests(some, length).collect())) == want


def test_substrings_documents(spark, sf_dir):
    got = collections.Counter(map(tuple, substrings.op7_repeated_substrings(spark, sf_dir).collect()))
    assert got == substrings_by_hand(documents(spark, sf_dir), 400)


def test_substrings_empty(nothing):
    assert substrings.digests(nothing, 400).collect() == []


# ---- near copies ----

def classes_by_hand(rows, share):
    sets = []
    for i, t in rows:
        w = [x.decode() for x in re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().lower())]
        sets.append((i, {tuple(w[j: j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())))
    where = {i: i for i, _ in sets if i is not None}

    def find(x):
        while where[x] != x:
            x = where[x]
        return x
    for i, a in sets:
        for j, b in sets:
            if i is not None and j is not None and i < j and a and b and 100 * len(a & b) >= share * len(a | b):
                x, y = find(i), find(j)
                where[max(x, y)] = min(x, y)
    return collections.Counter((i, len(s), None if i is None else find(i)) for i, s in sets)


@pytest.mark.parametrize("share", [85, 80])
def test_near_awkward(awkward, share):
    got = near_dedup.classes(awkward, near_dedup.Plan(share=share)).collect()
    assert collections.Counter(map(tuple, got)) == classes_by_hand([r[:2] for r in awkward_rows()], share)


def test_near_documents(spark, sf_dir):
    got = near_dedup.op10_near_dedup(spark, sf_dir).collect()
    assert collections.Counter(tuple(r)[:3] for r in got) == classes_by_hand(documents(spark, sf_dir), 85)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_large_group_in_blocks(spark, monkeypatch):
    """A chain of texts in which neighbours are alike and ends are not, dealt into many blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 300)
    words = [f"w{i}" for i in range(160)]
    rows = [(n, " ".join(words[2 * n: 2 * n + 100])) for n in range(25)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    assert collections.Counter(map(tuple, near_dedup.classes(df).collect())) == classes_by_hand(rows, 85)


def test_near_keeps_columns(awkward, nothing):
    kept = near_dedup.keep_first(awkward, near_dedup.Plan(share=80))
    assert kept.columns == awkward.columns
    assert sorted(r["h"] for r in kept.collect() if r["doc_id"] in (5, 10, 11, 12)) == [17]  # h of document 5
    assert sum(r["doc_id"] is None for r in kept.collect()) == 2
    assert near_dedup.classes(nothing).collect() == []


def test_posterior_bounds():
    plan = near_dedup.Plan()
    least = plan.least_matches()
    n, m = 40, int(least[40])
    tail = [sum(math.comb(n + 1, k) * 0.85 ** k * 0.15 ** (n + 1 - k) for k in range(x + 1)) for x in (m - 1, m)]
    assert tail[0] < plan.miss <= tail[1]


# ---- tokens ----

@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_tokens_equal_the_library(spark, awkward, name):
    path = token_counts.tokenizer_path(name)
    cache = f"{shared_folder(spark)}/cache-{name}"
    got = token_counts.count_tokens(awkward, cache, path).collect()
    texts = [(r[0], r[1] or "") for r in awkward_rows()]
    if name.endswith(".json"):
        from tokenizers import Tokenizer
        ids = [e.ids for e in Tokenizer.from_file(path).encode_batch([t for _, t in texts], add_special_tokens=False)]
    else:
        import sentencepiece
        ids = sentencepiece.SentencePieceProcessor(model_file=path).encode([t for _, t in texts])
    want = collections.Counter((i, len(t.encode()), len(x), len(x) > 512) for (i, t), x in zip(texts, ids))
    assert collections.Counter(map(tuple, got)) == want
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("digest").distinct().count() == len({t for _, t in texts})
    token_counts.count_tokens(awkward.filter("doc_id > 10"), cache, path).collect()
    assert spark.read.parquet(cache).count() == len({t for _, t in texts})  # all were there: nothing was encoded


def test_tokens_empty(spark, nothing):
    path = token_counts.tokenizer_path("byte_bpe_50k.json")
    assert token_counts.count_tokens(nothing, f"{shared_folder(spark)}/cache-none", path).collect() == []


# ---- language ----

def test_code_lengths_by_hand():
    """The folded tables give the same bits as walking the contexts byte by byte."""
    texts = {"a": "abracadabra abracadabra", "b": "banana bandana banana"}
    grams = []
    for n, t in enumerate(texts.values()):
        b = b"\n" * language_id.ORDER + t.encode()
        for d in range(language_id.ORDER + 1):
            c = collections.Counter(b[i - d: i + 1] for i in range(language_id.ORDER, len(b)))
            grams += [(d, int.from_bytes(g, "big"), n, k, g) for g, k in c.items()]
    import numpy as np
    model = language_id.build(list(texts), np.array([g[0] for g in grams]), np.array([g[1] for g in grams], np.uint64),
                              np.array([g[2] for g in grams]), np.array([g[3] for g in grams]))
    seen = {(n, g): k for _, _, n, k, g in grams}

    def bits(text, lang):
        b, total = b"\n" * language_id.ORDER + text.encode(), 0.0
        for i in range(language_id.ORDER, len(b)):
            for d in range(language_id.ORDER, -2, -1):
                if d < 0:
                    total += 8
                    break
                context = b[i - d: i]
                after = [k for (n, g), k in seen.items() if n == lang and len(g) == d + 1 and g[:-1] == context]
                n, kinds = sum(after), len(after)
                mine = seen.get((lang, b[i - d: i + 1]))
                if mine:
                    total -= math.log2(mine / (n + kinds))
                    break
                if n:
                    total -= math.log2(kinds / (n + kinds))
        return total
    asked = ["abra banana", "", "zz", "bandanabra\n"]
    got, size = language_id.code_lengths(model, pa.array(asked))
    assert size.tolist() == [len(t) for t in asked]
    for t, row in zip(asked, got):
        assert row == pytest.approx([bits(t, 0), bits(t, 1)], rel=1e-5)


def test_language_held_out(spark, sf_dir):
    got = {r["doc_id"]: r for r in language_id.op1_language_id(spark, sf_dir).collect()}
    truth = {r["doc_id"]: r["lang"] for r in table(spark, sf_dir, "documents").collect()}
    out = [i for i in truth if got[i]["held_out"]]
    assert len(got) == len(truth) and len(out) > 20
    assert sum(got[i]["lang_pred"] == truth[i] for i in out) >= 0.97 * len(out)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_awkward(awkward, nothing):
    model = language_id.train(awkward, sample_bytes=1 << 30, min_count=1)
    got = language_id.predict(awkward, model).collect()
    assert len(got) == len(awkward_rows()) and "id" in got[0].asDict()
    und = {r["h"] for r in got if r["lang_pred"] == "und"}
    assert und == {3, 4, 5, 13}
    kept = language_id.keep_known(awkward, model)
    assert kept.columns == awkward.columns and {r["h"] for r in kept.collect()} == set(range(20)) - und
    assert language_id.keep_known(awkward, model, most_bits=0.0).count() == 0
    assert {r["lang_pred"] for r in language_id.predict(awkward, language_id.train(nothing)).collect()} == {"und"}
    assert language_id.predict(nothing, model).collect() == []


# ---- quality ----

def test_quality_held_out(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in quality.op3_quality(spark, sf_dir).collect()}
    labels = table(spark, sf_dir, "labels").filter(held_out(F.col("doc_id"))).collect()
    right = sum(got[r["doc_id"]]["predicted"] == r["quality"] for r in labels)
    assert right >= 0.95 * len(labels) and got.keys() >= {r["doc_id"] for r in labels}


def test_quality_awkward(spark, awkward, nothing):
    labels = spark.createDataFrame(
        [(10, 1), (10, 0), (21, 1), (22, 0), (23, None), (999, 1), (None, 0), (13, 0)], "doc_id BIGINT, quality INT")
    model = quality.train(awkward, labels)
    got = quality.score(awkward, model, kept=["doc_id", "h"]).collect()
    assert len(got) == len(awkward_rows()) and all(0 < r["score"] < 1 for r in got)
    assert quality.score(nothing, model, kept=["doc_id"]).collect() == []
    plain = quality.train(nothing, labels)
    assert {r["score"] for r in quality.score(awkward, plain, kept=["h"]).collect()} == {0.5}


def test_quality_pairs_learn_what_single_tables_cannot():
    import numpy as np
    r = np.random.default_rng(0)
    rows = r.random((2000, len(quality.FEATURES)))
    labels = ((rows[:, 0] > 0.5) ^ (rows[:, 1] > 0.5)).astype(float)
    right = [((quality.fit(rows, labels, rounds=40, pair_count=n).score(rows) > 0.5) == labels).mean() for n in (0, 2)]
    assert right[0] < 0.75 and right[1] > 0.9
