"""Toxicity: held-out accuracy, the model against sums written out, awkward rows."""

from __future__ import annotations

import math
import pickle
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.llm import toxicity
from martloom.llm.common import held_out, table
from tests.llm.conftest import awkward_rows


def test_toxicity_held_out(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in toxicity.op13_toxicity(spark, sf_dir).collect()}
    assert len(got) == table(spark, sf_dir, "documents").count() and all(0 <= r["score"] <= 1 for r in got.values())
    labels = table(spark, sf_dir, "labels").filter(held_out(F.col("doc_id"))).collect()
    right = sum(got[r["doc_id"]]["predicted"] == r["toxic"] for r in labels)
    assert right >= 0.95 * len(labels)
    caught = [got[r["doc_id"]]["predicted"] for r in labels if r["toxic"] == 1]
    assert sum(caught) >= 0.7 * len(caught)


def words(text):
    out = []
    for b in text.encode() + b" ":
        s = int(toxicity.SYMBOLS[b])
        if s:
            out.append(s)
        elif out:
            yield [*out, 0]
            out = []


def grams(text):
    """Context and symbol of every symbol, the context as far back as seven symbols of the word."""
    for w in words(text):
        for i, s in enumerate(w):
            yield tuple(w[max(0, i - 7): i]), s


def code(context, s):
    return sum(x << (6 * k) for k, x in enumerate([s, *reversed(context)]))


TOXIC = ["you idiot you moron", "idiot stupid idea", "such a stupid moron é9"]
PLAIN = ["you are kind", "a kind idea such a day", "stud idle mor such kindness", "été 2024 a day"]


def test_model_equals_sums_written_out(spark):
    rows = spark.createDataFrame([(t, 1) for t in TOXIC] + [(t, 0) for t in PLAIN], "text STRING, toxic INT").repartition(3)
    rule = toxicity.Rule()
    counts = toxicity._ngrams(rows)
    seen = {c: Counter(code(*g) for t in texts for g in grams(t)) for c, texts in (("toxic", TOXIC), ("ordinary", PLAIN))}
    assert {(r["gram"], r["toxic"], r["ordinary"]) for r in counts.collect()} == {
        (g, seen["toxic"][g], seen["ordinary"][g]) for g in seen["toxic"].keys() | seen["ordinary"].keys()}
    # Interpolated Kneser-Ney of both classes: continuation counts below the highest order.
    n = {8: Counter(seen["toxic"] + seen["ordinary"])}
    for k in range(7, 0, -1):
        n[k] = Counter(g & ((1 << (6 * k)) - 1) for g in n[k + 1])

    def shared(g, k):
        inside = [x for x in n[k] if x >> 6 == g >> 6]
        whole = sum(n[k][x] for x in inside)
        if k == 1:
            return n[k][g] / whole
        below = shared(g & ((1 << (6 * (k - 1))) - 1), k - 1)
        return (max(n[k][g] - rule.shared, 0) + rule.shared * len(inside) * below) / whole
    of = defaultdict(list)
    for g in n[8]:
        of[g >> 6].append(g)

    def likely(g, c):
        whole = sum(seen[c][x] for x in of[g >> 6])
        free = rule.discount * sum(seen[c][x] > 0 for x in of[g >> 6]) / whole if whole else 1.0
        return (max(seen[c][g] - rule.discount, 0) / whole if whole else 0.0) + free * shared(g, 8), free
    want, others = {}, {}
    for context, inside in of.items():
        ratio = {g: math.log(likely(g, "toxic")[0] / likely(g, "ordinary")[0]) for g in inside}
        unseen = math.log(likely(inside[0], "toxic")[1] / likely(inside[0], "ordinary")[1])
        usual = {g: likely(g, "ordinary")[0] for g in inside}
        centre = sum(usual[g] * ratio[g] for g in inside) + max(1 - sum(usual.values()), 0) * unseen
        want |= {g: ratio[g] - centre for g in inside}
        others[context] = unseen - centre
    got, contexts = toxicity.log_ratios(counts, rule)
    found = {r["key"]: r["value"] for r in got.collect()}
    assert found.keys() == want.keys() and all(math.isclose(found[g], want[g], abs_tol=1e-5) for g in want)
    found = {r["key"]: r["value"] for r in contexts.collect()}
    assert found.keys() == others.keys() and all(math.isclose(found[c], others[c], abs_tol=1e-5) for c in others)

    model = toxicity.Model(toxicity.cells(got, 16), toxicity.cells(contexts, 15), rule.mixed)
    for text in ["idiots are kind", "you", "", "?!", "nothing known here"]:
        gains = []
        for w in words(text):
            total = sum(want.get(code(tuple(w[max(0, i - 7): i]), s), others.get(code(tuple(w[max(0, i - 7): i]), s) >> 6, 0.0))
                        for i, s in enumerate(w))
            gains.append(math.log(1 - rule.mixed + rule.mixed * math.exp(total)))
        data = np.frombuffer(text.encode(), np.uint8)
        got_one = model.per_word(data, np.array([0, len(data)]))[0]
        assert math.isclose(got_one, sum(gains) / len(gains) if gains else 0.0, abs_tol=2e-3)


def test_toxicity_awkward(spark, awkward, nothing):
    labels = spark.createDataFrame(
        [(10, 1), (10, 0), (17, 0), (18, 0), (21, 0), (22, 1), (23, None), (24, 5), (999, 1), (None, 1), (13, 0), (16, 0)],
        "doc_id BIGINT, toxic INT")
    scorer = toxicity.train(awkward, labels)
    got = toxicity.score(awkward, scorer).collect()
    assert len(got) == len(awkward_rows()) and all(0 <= r["score"] <= 1 for r in got)
    blank = {round(r["score"], 9) for r, row in zip(sorted(got, key=str), sorted(got, key=str)) if r["doc_id"] in (13, 14, 15)}
    assert len(blank) == 1
    assert toxicity.score(nothing, scorer).collect() == []
    # One class only, and nothing at all.
    assert {r["score"] for r in toxicity.score(awkward, toxicity.train(awkward, labels.filter("toxic = 0"))).collect()} == {0.0}
    assert {r["score"] for r in toxicity.score(awkward, toxicity.train(awkward, labels.filter("toxic = 1"))).collect()} == {1.0}
    assert {r["score"] for r in toxicity.score(awkward, toxicity.train(nothing, labels.filter("false"))).collect()} == {0.0}


@pytest.mark.parametrize("bits", [4, 12])
def test_full_tables_keep_the_frequent(spark, bits):
    rows = [(k, float(k % 7), k) for k in range(1, 400)]
    table_ = toxicity.cells(spark.createDataFrame(rows, "key BIGINT, value FLOAT, many BIGINT"), bits)
    value, seen = table_(np.arange(1, 400))
    assert seen[-1] and value[-1] == 399 % 7
    assert seen.sum() >= min(1 << bits, 300) * 0.8 and not table_(np.array([10 ** 9]))[1].all() or bits == 4


def test_scores_do_not_depend_on_the_size_of_the_tables(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    wide, tight = (toxicity.train(docs, labels, toxicity.Rule(cells=bits)) for bits in (23, 9))
    assert tight.rest.count() > 1000
    want, got = ({r["doc_id"]: r["score"] for r in toxicity.score(docs, s).collect()} for s in (wide, tight))
    assert want.keys() == got.keys() and all(math.isclose(want[d], got[d], abs_tol=1e-9) for d in want)


def test_tables_know_their_keys_exactly():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 48, 200_000))
    cell, rest = toxicity._spread(keys, 9)
    assert len(np.unique((rest << np.uint64(9)) | cell.astype(np.uint64))) == len(keys)


def test_the_driver_hands_on_tables_it_does_not_unpack(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    scorer = toxicity.train(docs, labels)
    toxicity.score(docs, scorer).count()
    assert getattr(scorer.model, "_value", None) is None  # what PySpark keeps once the driver has read a broadcast
    rows = spark.createDataFrame([(k, float(k % 7), k) for k in range(1, 400)], "key BIGINT, value FLOAT, many BIGINT")
    made = toxicity.cells(rows, 20)
    assert made._open is None and sum(map(len, made.blocks.values())) < 100_000
    sent = pickle.loads(pickle.dumps(made))
    assert all((a == b).all() for a, b in zip(made(np.arange(500)), sent(np.arange(500))))
