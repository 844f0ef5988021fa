"""Quality scores by a generalised additive model with pairwise interactions.

Boosting goes round the features in turn; each step fits a shallow tree to the bins of one feature and adds it, damped, to
that feature's lookup table. When the single tables are done, the pairs whose joint bins explain most of what is left
get tables of their own in the same way. A score is the logistic of a sum of table cells, so a batch of documents is
scored by a few array look-ups.

The features are counts over the whole text, made from its bytes alone. The fit reads a bounded sample: about `rows`
labelled documents, drawn by a seeded hash of the id. Only their features, never their texts, come to the driver.

Cases: null and empty texts have all features 0 and are scored; a document with several labels is learned from once for
each; null labels and labels without a document are not learned from; without labels every score is 0.5; very long
texts are read whole; repeated rows score alike; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import U64, held_out, mix, pieces, stored, table, text_bytes, word_hashes, words

FEATURES = [
    "log_bytes", "log_words", "word_bytes", "upper", "digits", "exclaim", "symbols", "bars", "sentence_marks", "lines",
    "beyond_ascii", "repeat_next", "distinct_words", "distinct_pairs", "short_words", "long_words", "marked_words",
    "at_signs", "brackets", "top_word",
]
BINS = 32


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES per text."""
    n = len(offsets) - 1
    out = np.zeros((n, len(FEATURES)))
    size = np.diff(offsets)
    kind = np.zeros(256, np.int64)
    for i, chars in enumerate([b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!", b"$#%&*=+~^_<>", b"|", b".,;:?", b"\n",
                               bytes(range(128, 256)), b"@", b"()[]{}"], 1):
        kind[list(chars)] = i
    doc = np.repeat(np.arange(n), size)
    per = np.bincount(doc * 11 + kind[data], minlength=n * 11).reshape(n, 11) / np.maximum(size, 1)[:, None]
    starts, ends, first = words(data, offsets)
    count = np.diff(first)
    some = np.maximum(count, 1)
    word_doc = np.repeat(np.arange(n), count)
    length = ends - starts
    hashes = word_hashes(data, starts, ends)

    def share(flags: np.ndarray, where: np.ndarray = word_doc) -> np.ndarray:
        return np.bincount(where, flags, n) / some

    def kinds(keys: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys per text and the count of the most frequent one."""
        if not len(keys):
            return np.zeros(n), np.zeros(n)
        _, at, times = np.unique(mix(keys ^ mix(where.astype(U64))), return_index=True, return_counts=True)
        top = np.zeros(n)
        np.maximum.at(top, where[at], times)
        return np.bincount(where[at], minlength=n), top
    same = word_doc[1:] == word_doc[:-1]
    different, top = kinds(hashes, word_doc)
    pairs, _ = kinds((hashes[:-1] * U64(3) + hashes[1:])[same], word_doc[1:][same])
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    columns = {
        "log_bytes": np.log1p(size), "log_words": np.log1p(count), "word_bytes": np.bincount(word_doc, length, n) / some,
        "upper": per[:, 1], "digits": per[:, 2], "exclaim": per[:, 3], "symbols": per[:, 4], "bars": per[:, 5],
        "sentence_marks": per[:, 6], "lines": per[:, 7], "beyond_ascii": per[:, 8], "at_signs": per[:, 9],
        "brackets": per[:, 10], "repeat_next": share(((hashes[1:] == hashes[:-1]) & same), word_doc[1:]),
        "distinct_words": different / some, "distinct_pairs": pairs / np.maximum(count - 1, 1), "top_word": top / some,
        "short_words": share(length <= 3), "long_words": share(length > 12), "marked_words": share(kind[last] > 0),
    }
    for i, name in enumerate(FEATURES):
        out[:, i] = columns[name]
    return out


@dataclass
class Model:
    edges: list[np.ndarray]
    base: float
    single: np.ndarray
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def bins(self, rows: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, rows[:, i], "right") for i, e in enumerate(self.edges)])

    def score(self, rows: np.ndarray) -> np.ndarray:
        at = self.bins(rows)
        total = np.full(len(rows), self.base)
        for i in range(len(self.edges)):
            total += self.single[i][at[:, i]]
        for (i, j), cells in self.pairs.items():
            total += cells[at[:, i], at[:, j]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Best gain of one cut along the bins, and the bin after it."""
    left, right = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    won = _gain(left, right) + _gain(g.sum() - left, h.sum() - right) - _gain(g.sum(), h.sum())
    if not len(won):
        return 0.0, 0
    best = int(won.argmax())
    return float(won[best]), best + 1


def shallow_tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Step per bin of a tree over one feature's bins."""
    won, at = _cut(g, h) if depth else (0.0, 0)
    if won <= 1e-9:
        return np.full(len(g), -g.sum() / (h.sum() + 1.0))
    return np.concatenate([shallow_tree(g[:at], h[:at], depth - 1), shallow_tree(g[at:], h[at:], depth - 1)])


def pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and steps of one cut along the first axis and one along the second on each side."""
    _, at = _cut(g.sum(1), h.sum(1))
    out, won = np.zeros_like(g), 0.0
    for side in (slice(0, at), slice(at, None)):
        gs, hs = g[side].sum(0), h[side].sum(0)
        if not hs.sum():
            continue
        gain, _ = _cut(gs, hs)
        won += gain + float(_gain(gs.sum(), hs.sum()))
        out[side] = shallow_tree(gs, hs, 1)
    return won - float(_gain(g.sum(), h.sum())), out


def fit(rows: np.ndarray, labels: np.ndarray, *, rounds: int = 120, pair_count: int = 6, rate: float = 0.1) -> Model:
    """Cyclic boosting of single tables, then of the best pairs."""
    edges = [np.unique(np.quantile(rows[:, i], np.arange(1, BINS) / BINS)) if len(rows) else np.zeros(0)
             for i in range(len(FEATURES))]
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    model = Model(edges, float(np.log(share / (1 - share))), np.zeros((len(FEATURES), BINS + 1)))
    if not len(rows):
        return model
    at, total = model.bins(rows), np.full(len(rows), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return p - labels, p * (1 - p)
    for _ in range(rounds):
        for i in range(len(FEATURES)):
            g, h = slopes()
            step = rate * shallow_tree(np.bincount(at[:, i], g, BINS + 1), np.bincount(at[:, i], h, BINS + 1))
            model.single[i] += step
            total += step[at[:, i]]
    width = BINS + 1

    def joint(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        g, h = slopes()
        cell = at[:, i] * width + at[:, j]
        return (np.bincount(cell, g, width * width).reshape(width, width),
                np.bincount(cell, h, width * width).reshape(width, width))
    ranked = sorted(((pair_tree(*joint(i, j))[0], i, j) for i in range(len(FEATURES)) for j in range(i)), reverse=True)
    for _ in range(rounds // 4):
        for _, i, j in ranked[:pair_count]:
            step = rate * pair_tree(*joint(i, j))[1]
            model.pairs[i, j] = model.pairs.get((i, j), 0) + step
            total += step[at[:, i], at[:, j]]
    return model


def _mapped(docs: DataFrame, text: str, kept: list[str], schema: str, made) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, text, 2 << 20):
            columns, names = made(features(*text_bytes(part.column(text))))
            yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + columns, [*kept, *names])
    return docs.select(*kept, text).mapInArrow(run, schema)


def train(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", label: str = "quality", text: str = "text",
    rows: int = 20_000, seed: int = 29,
) -> Model:
    """Fit on about `rows` of the labelled documents."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.col(label).cast("int").alias("_label"))
    share = rows / max(known.count(), 1)
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("_key")), F.lit(1 << 30)) / float(1 << 30)
    # The stored sample has a size that the planner knows, so it decides between broadcast and shuffle.
    sample = stored(known.filter(draw < share), "quality-labels")
    asked = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(sample, "_key")
    got = _mapped(asked, "_text", ["_key", "_label"], "_key BIGINT, _label INT, row ARRAY<DOUBLE>", lambda x: (
        [pa.array(list(x), pa.list_(pa.float64()))], ["row"])).toPandas().sort_values(["_key", "_label"], kind="stable")
    values = np.array(got["row"].tolist(), float).reshape(len(got), len(FEATURES))
    return fit(values, got["_label"].to_numpy(float))


def score(docs: DataFrame, model: Model, *, kept: list[str], text: str = "text") -> DataFrame:
    """The kept columns and the score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    types = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join(f"`{c}` {types[c]}" for c in kept) + ", score DOUBLE"
    return _mapped(docs, text, kept, schema, lambda x: ([pa.array(shared.value.score(x))], ["score"]))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; fitted to labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id"))))
    return score(docs, model, kept=["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))
