"""Reply trees, search, mixing, decontamination and the pipeline, held against brute force or SQL."""

from __future__ import annotations

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from martloom.llm import decontaminate, language_id, metric_search, mixing, near_dedup, reply_trees
from martloom.llm.common import held_out, stored, table
from tests.llm.conftest import awkward_rows, story
from tests.llm.test_texts import classes_by_hand, passages_by_hand  # noqa: F401

SF = "/root/testdata/sf0.01"


def same(df, sql, sf_dir, duck):
    names, want = duck(sql, sf_dir)
    assert sorted(df.columns) == sorted(names)
    got = [tuple(r) for r in df.select(*names).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want)) and got


# ---- reply trees ----

def odd_text(r: random.Random) -> str:
    parts = ["[INST]", "[/INST]", "</s>", "<s>", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[/TURN]", "\\", "[", "<", "/",
             " ", "\n", "INST]", "s>", "ä", "\U0001f600", "x", "[\\INST]", "<\\/s>", "$1"]
    return "".join(r.choice(parts) for _ in range(r.randint(0, 9)))


def tree_rows(seed: int) -> list[tuple]:
    """tree, id, parent, role, text, score: random trees, a missing parent, a ring, nulls, a long chain."""
    r = random.Random(seed)
    rows = [(t, f"{t}.{i}", f"{t}.{r.randrange(i)}" if i else None, r.choice(["user", "assistant", "system", "tool", None]),
             r.choice([odd_text(r), odd_text(r), None]), r.choice([None, 0.5, 1.0, 2.0]))
            for t in range(12) for i in range(r.randint(1, 14))]
    rows += [(50, f"50.{i:03d}", f"50.{i - 1:03d}" if i else None, "user", str(i), 1.0) for i in range(37)]
    rows += [(60, "60.1", "gone", "user", "root after all", 1.0), (61, "61.1", "61.2", "user", "a", 1.0),
             (61, "61.2", "61.1", "user", "b", 1.0), (61, "61.3", "61.2", "user", "c", 1.0),
             (None, "n.1", None, "user", "no tree", 1.0)]
    return rows


def paths_by_hand(rows, branches):
    by_id = {r[1]: r for r in rows}
    parents = {r[2] for r in rows}
    found = collections.defaultdict(list)
    for r in rows:
        if r[1] in parents:
            continue
        path, at = [], r
        while at is not None and len(path) <= len(rows):
            path.append(at)
            at = by_id.get(at[2])
        if at is None:
            path.reverse()
            found[r[0]].append((-sum(p[5] or 0.0 for p in path) / len(path), r[1], [(p[3] or "", p[4] or "") for p in path]))
    return {(t, leaf): turns for t, some in found.items() for _, leaf, turns in sorted(some)[:branches]}


@pytest.mark.parametrize("branches", [1, 2, None])
def test_trees(spark, branches):
    rows = tree_rows(4)
    df = spark.createDataFrame(rows, "tree BIGINT, id STRING, parent STRING, role STRING, text STRING, score DOUBLE")
    got = reply_trees.format_trees(df, branches).collect()
    want = paths_by_hand(rows, branches)
    assert {(r["tree"], r["leaf"]) for r in got} == set(want)
    for r in got:
        turns = want[r["tree"], r["leaf"]]
        assert reply_trees.read_back(r["formatted"]) == turns and r["n_turns"] == len(turns)
        learn = [reply_trees.unescaped(r["formatted"][s["start"]: s["end"]]) for s in r["loss"]]
        assert learn == [t for role, t in turns if role == "assistant"]


def test_chat_digests(spark, duck):
    talks = collections.defaultdict(list)
    for c, role, text in duck("SELECT conv_id, role, text FROM conversations ORDER BY conv_id, turn", SF)[1]:
        talks[c].append((role or "", text or ""))
    talks[-7] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    got = {r["conv_id"]: r for r in reply_trees.op4_chat_format(spark, SF).collect()}
    assert got.keys() == talks.keys()
    for c, turns in talks.items():
        learn = "".join(t for role, t in turns if role == "assistant")
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (got[c]["n_turns"], got[c]["loss_chars"]) == (len(turns), len(learn))
        assert got[c]["loss_sha256"] == hashlib.sha256(learn.encode()).hexdigest()


def test_chat_awkward(spark):
    schema = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, tree INT, id INT"
    rows = [(1, 0, "user", "a", 1, 1), (1, 0, "user", "a", 1, 1), (1, None, None, None, 1, 1), (1, 2, "assistant", "", 1, 1),
            (None, 0, "assistant", "lost", 1, 1), (None, 1, "x", "y", 1, 1)]
    got = reply_trees.digests(reply_trees.format_trees(reply_trees.linear(spark.createDataFrame(rows, schema)))).collect()
    assert {(r["conv_id"], r["n_turns"], r["loss_chars"]) for r in got} == {(1, 4, 0), (None, 2, 4)}
    empty = spark.createDataFrame([], schema)
    assert reply_trees.format_trees(reply_trees.linear(empty)).collect() == []


# ---- search ----

def test_search_sql(spark, duck):
    same(metric_search.op8_metric_search(spark, SF), metric_search.SQL, SF, duck)


def test_search_awkward(spark, monkeypatch):
    """Small pages and blocks, ties, copies, broken vectors, other lengths, shared ids."""
    for name, n in (("PAGE", 4), ("FANOUT", 3), ("BLOCK_ROWS", 60), ("QUERY_ROWS", 3)):
        monkeypatch.setattr(metric_search, name, n)
    r = random.Random(1)
    rows = [(i, [r.choice([-1.0, 0.0, 0.5, 1.0, 0.001]) for _ in range(6)]) for i in range(300)]
    rows += [(i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(300, 350)] + [(50, [0.0] * 6), (50, [0.0] * 6)]
    rows += [(400, None), (401, [1.0, None]), (402, [float("nan"), 1.0]), (403, [float("inf"), 1.0]), (None, [1.0] * 6),
             (450, [2.0, 1.0]), (451, [1.0, 1.0]), (500, []), (501, [])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id BIGINT, embedding ARRAY<FLOAT>, id STRING")
    flat = stored(metric_search.quantised(df), "flat")
    got = metric_search.search(metric_search.build_index(flat), flat.filter("id % 50 = 0")).collect()
    good = {(i, tuple(float(int(256 * x // 1)) for x in v)) for i, v in rows
            if i is not None and v is not None and all(x is not None and abs(x) < 1e9 for x in v)}
    good = {(i, tuple(x if x != -0.0 else 0.0 for x in v)) for i, v in good}
    want = {}
    for q, a in good:
        if q % 50 == 0:
            scores = [(-int(sum(x * y for x, y in zip(a, b))), i) for i, b in good if i != q and len(a) == len(b)]
            want[q] = sorted(want.get(q, []) + scores)[:5]
    found = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got}
    assert found == {(q, n, i, -s) for q, some in want.items() for n, (s, i) in enumerate(some, 1)}
    none = metric_search.quantised(df.filter("false"))
    assert metric_search.search(metric_search.build_index(none), none).collect() == []


# ---- mixing ----

@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", SF])
def test_mixing_sql(spark, duck, sf_dir):
    same(mixing.op6_mixing(spark, sf_dir), mixing.SQL, sf_dir, duck)


def test_shortages_go_to_siblings_first(spark):
    rows = [("a", "x", 10), ("a", "y", 1000), ("b", "x", 1000), ("b", "y", 1000)]
    df = spark.createDataFrame([(n, None, *r[:2], r[2]) for n, r in enumerate(rows)],
                               "_key BIGINT, t STRING, _top STRING, _low STRING, n_tokens BIGINT")
    recipe = mixing.Recipe(share=(800, 3010), epochs=1, weights={})
    got = {(r["_top"], r["_low"]): int(r["allot"]) for r in mixing.budgets(df, ["top", "low"], recipe).collect()}
    assert got == {("a", "x"): 10, ("a", "y"): 390, ("b", "x"): 200, ("b", "y"): 200}
    tight = mixing.Recipe(share=(2800, 3010), epochs=1, weights={})
    got = {(r["_top"], r["_low"]): int(r["allot"]) for r in mixing.budgets(df, ["top", "low"], tight).collect()}
    assert got == {("a", "x"): 10, ("a", "y"): 1000, ("b", "x"): 895, ("b", "y"): 895}


def test_mixing_awkward(awkward, nothing):
    out = mixing.mixed(awkward, mixing.Recipe(share=(2, 1), epochs=2))
    assert out.columns == awkward.columns and dict(out.dtypes)["copies"] == "int"
    got = {r["h"]: r["copies"] for r in out.collect()}
    words = {r[7]: len((r[1] or "").split()) for r in awkward_rows()}
    assert all(got.get(h) == 2 for h, n in words.items() if n)  # the budget is all that two passes hold
    half = mixing.mixed(awkward, mixing.Recipe(share=(1, 2), epochs=1)).collect()
    assert 0 < sum(words[r["h"]] * r["copies"] for r in half) <= sum(words.values()) / 2
    assert mixing.mixed(nothing, mixing.Recipe()).collect() == []


# ---- decontamination ----

ITEM = "A train leaves Boston at 9 and drives 120 km north before Maria boards it with 3 heavy bags near the old harbour."


@pytest.fixture(scope="session")
def bench(spark):
    return spark.createDataFrame(
        [(1, ITEM, "t"), (1, ITEM, "t"), (2, None, "t"), (3, "", "t"), (4, "three tiny words", "t"), (None, story(90, 30), "t"),
         (6, "short items count as one window", "t"), (7, "4 5 6 7 8 9 10 11 12 13", "t")], "item_id BIGINT, text STRING, t STRING")


def test_leaks_by_template(spark, awkward, bench, nothing):
    other = ITEM.replace("Boston", "Denver").replace("9", "17").replace("120", "4,500").replace("Maria", "Olga")
    twice = ITEM.replace("Boston", "Denver").replace("Maria", "Denver")  # two names become one: not the same question
    cases = [(100, "So. " + ITEM.upper().lower() + " End."), (101, story(70, 40) + ". " + other + " " + story(71, 9)),
             (102, twice), (103, "they said short items count as one window to us"), (104, "4 5 6 7 8 9 10 11 12 13"),
             (105, ITEM[:30]), (106, story(90, 30) + " more"), (107, story(72, 200)), (108, ITEM), (108, ITEM)]
    extra = spark.createDataFrame(cases, "doc_id BIGINT, text STRING")
    docs = awkward.unionByName(extra, allowMissingColumns=True)
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns
    gone = {i for i, _ in cases} - {r["doc_id"] for r in kept.filter("doc_id >= 100").collect()}
    assert gone == {101, 103, 106, 108}  # 100 has lost its names to lower case
    assert kept.filter("doc_id IS NULL OR doc_id < 100").count() == len(awkward_rows())
    assert decontaminate.clean(docs, bench.filter("false")).count() == docs.count()
    assert decontaminate.clean(nothing, bench).collect() == []


def test_leaks_documents(spark, duck):
    got = {r["doc_id"] for r in decontaminate.op2_decontaminate(spark, SF).filter("contaminated").collect()}
    exact = {r[0] for r in duck("SELECT DISTINCT doc_id FROM documents d, benchmark b WHERE contains(d.text, b.text)", SF)[1]}
    assert got == exact and exact


# ---- pipeline ----

def test_pipeline_stages(spark, sf_dir):
    """Each stage does on its own input what its operator does by hand."""
    docs = table(spark, sf_dir, "documents")
    names = docs.columns
    outs = []
    for _, stage in corpus_pipeline.STAGES:
        outs.append(stored(stage(spark, outs[-1] if outs else docs, sf_dir), "t"))
    texts = [{r["doc_id"]: r["text"] for r in df.collect()} for df in [docs, *outs]]
    assert all(df.columns == names for df in outs[:-1]) and outs[-1].columns == [*names, "copies"]
    model = language_id.train(docs.filter(~held_out(F.col("doc_id"))))
    bad = language_id.predict(docs, model).filter("lang_pred = 'und'").count()
    assert len(texts[1]) == len(texts[0]) - bad
    classes = classes_by_hand(list(texts[1].items()), 80)
    assert set(texts[2]) == {i for i, _, c in classes if i == c}
    want = {i: (n, gone) for i, n, gone, _ in passages_by_hand(list(texts[2].items()), 13)}
    assert set(texts[3]) == {i for i, (n, gone) in want.items() if gone < n or not n}
    assert all(len(texts[3][i].split()) == want[i][0] - want[i][1] for i in texts[3])
    items = [r["text"] for r in table(spark, sf_dir, "benchmark").collect()]
    assert set(texts[4]) == {i for i, t in texts[3].items() if not any(x in t for x in items)}
    total = sum(len(t.split()) for t in texts[4].values())
    used = sum(len(r["text"].split()) * r["copies"] for r in outs[-1].collect())
    assert 0 < used <= total / 2  # whole documents only: small leaves stay below their share
    assert near_dedup.Plan(share=80).bands > near_dedup.Plan().bands
