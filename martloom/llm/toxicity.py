"""Toxicity by class-conditional Kneser-Ney models of spelling.

1. A text is a row of words (letters and digits; A-Z lower-cased), a word a row of symbols with an end. Each symbol is
   predicted from those before it in the word, at most seven. Toxic and ordinary training texts are counted apart.
2. Each class has its own counts at the highest order, with an absolute discount. What the discount frees is given to one
   distribution that both classes share: interpolated Kneser-Ney over the counts of both, whose lower orders use
   continuation counts. A rare spelling therefore scores as likely under one class as under the other, and a new word
   with the stem of a toxic one takes part in what is known of the stem.
3. The log-ratio of the two classes is taken around its mean under the ordinary class, context by context, so a language
   of which there are few toxic texts is not favoured. A word's likelihood ratio is the product over its symbols; a toxic text
   is a text of ordinary words mixed with a small share of toxic ones. The score rests on the difference of the two
   log-likelihoods, divided by the number of words.
4. A logistic curve turns it into a probability. It is fitted to a sixth of the training rows, which the model does not see.

Counts, continuation counts and the curve are made of all labelled rows, as tables that grow with them. What travels to
the tasks is of a fixed size: two hash tables of 2^`cells` and 2^(`cells` - 1) cells, each with all that tells its key from others.
Where two n-grams meet in one cell, the more frequent one keeps it, the cell is marked as shared, and the others stay in a
table on Spark (`Scorer.rest`). A word with a symbol that only this table can settle is scored by joining with it, so scores do not
depend on the size of the hash tables.

Cases: null and empty texts and texts without a word get the score of a text that tells nothing; very long texts are read
whole; rows with a null id have no label; of several labels of an id, toxic wins; repeated rows are scored alike and count
each time they are labelled; labels other than 0 and 1 are not used. Without rows of both classes to learn from, every score is the
share of toxic rows (0 without any rows). An empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.llm.common import U64, held_out, pieces, stored, table, text_bytes
from martloom.llm.places import deflate, inflate

ORDER, BITS = 8, 6
CHUNK = 2 << 20
BLOCK_BITS = 13  # cells of a row on the way to the driver


@dataclass(frozen=True)
class Rule:
    """Discounts of the shared and the class models, share of toxic words in a toxic text, size of the tables."""

    shared: float = 0.75
    discount: float = 0.9
    mixed: float = 0.01
    cells: int = 23


def _symbols() -> np.ndarray:
    out = np.zeros(256, np.int64)
    for c in range(256):
        if 97 <= c <= 122 or 65 <= c <= 90:
            out[c] = (c & 31)
        elif 48 <= c <= 57:
            out[c] = 27
        elif c >= 192:
            out[c] = 28 + (c & 3)
        elif c >= 128:
            out[c] = 32 + (c & 31)
    return out


SYMBOLS = _symbols()


def spelled(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code of every symbol with its context, index of each word's first code, and the text of each word.

    A code holds up to ORDER symbols, the last one lowest; a context reaches back to the start of its word. Each word is
    followed by the symbol 0.
    """
    n = len(offsets) - 1
    x = np.insert(SYMBOLS[data], offsets[1:], 0)
    text = np.repeat(np.arange(n), np.diff(offsets) + 1)
    keep = np.ones(len(x), bool)
    if len(x):
        keep[1:] = (x[1:] != 0) | (x[:-1] != 0)
        keep[0] = x[0] != 0
    x, text = x[keep], text[keep]
    ends = np.flatnonzero(x == 0)
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(ends)].astype(np.int64)
    return coded(x, starts), starts, text[ends]


def coded(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Code of every symbol of words that stand on end."""
    code = x.copy()
    for reach in (1, 2, 4):
        longer = code.copy()
        longer[reach:] |= code[:-reach] << (BITS * reach)
        code = longer
    within = np.arange(len(x)) - np.repeat(starts, np.diff(np.append(starts, len(x))))
    return code & ((np.int64(1) << (BITS * (np.minimum(within, ORDER - 1) + 1))) - 1)


# ---- counts and the model as tables ----

def _ngrams(rows: DataFrame) -> DataFrame:
    """gram, and its occurrences in toxic and ordinary rows. rows: text, toxic."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text", CHUNK):
            toxic = part.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
            code, starts, text = spelled(*text_bytes(part.column("text")))
            if not len(code):
                continue
            kind = toxic[np.repeat(text, np.diff(np.append(starts, len(code))))]
            pairs, many = np.unique(code * 2 + kind, return_counts=True)
            grams, at = np.unique(pairs >> 1, return_inverse=True)
            of_class = [np.bincount(at, many * ((pairs & 1) == k), len(grams)).astype(np.int64) for k in (1, 0)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (grams, *of_class)], ["gram", "toxic", "ordinary"])
    counted = rows.mapInArrow(run, "gram BIGINT, toxic BIGINT, ordinary BIGINT")
    return stored(counted.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")), "grams")


def _last(gram: str, k: int) -> Column:
    return F.col(gram).bitwiseAND(F.lit((1 << (BITS * k)) - 1))


def _of_context(c: Column) -> Column:
    """An aggregate over the rows of a context: one n-gram for every symbol at most, so few."""
    return c.over(Window.partitionBy("context"))


def _interpolated(grams: DataFrame, d: float, lower: DataFrame | None, k: int) -> DataFrame:
    """grams with context and p: an absolute discount on n; the mass freed in a context goes by the next lower order."""
    if lower is not None:
        below = lower.select(F.col("gram").alias("lower"), F.col("p").alias("q"))
        grams = grams.withColumn("lower", _last("gram", k - 1)).join(below, "lower").drop("lower")
    met = grams.withColumn("context", F.shiftright("gram", BITS)).withColumns(
        {"all": _of_context(F.sum("n")), "kinds": _of_context(F.count(F.lit(1)))})
    p = F.col("n") / F.col("all") if lower is None else \
        (F.greatest(F.col("n") - d, F.lit(0.0)) + d * F.col("kinds") * F.col("q")) / F.col("all")
    return met.withColumn("p", p).select("context", *[c for c in grams.columns if c != "q"], "p")


def shared_model(counts: DataFrame, d: float) -> DataFrame:
    """counts with context and p: interpolated Kneser-Ney of the highest order over both classes."""
    levels = {ORDER: counts.withColumn("n", F.col("toxic") + F.col("ordinary"))}
    for k in range(ORDER - 1, 0, -1):
        kinds = levels[k + 1].groupBy(_last("gram", k).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        levels[k] = stored(kinds, f"order-{k}")
    lower = None
    for k in range(1, ORDER):
        lower = stored(_interpolated(levels[k], d, lower, k).select("gram", "p"), f"shared-{k}")
    return _interpolated(levels[ORDER], d, lower, ORDER)


def log_ratios(counts: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """Centred log-ratios of the classes: (key, value, many) of n-grams, and of contexts for what was not seen in them.

    counts: gram, toxic, ordinary.
    """
    classes = ("toxic", "ordinary")
    rows = shared_model(counts, rule.shared).withColumns(
        {f"all_{c}": _of_context(F.sum(c)) for c in classes}
        | {f"kinds_{c}": _of_context(F.sum((F.col(c) > 0).cast("int"))) for c in classes})

    def freed(c: str) -> Column:
        return F.when(F.col(f"all_{c}") > 0, rule.discount * F.col(f"kinds_{c}") / F.col(f"all_{c}")).otherwise(1.0)

    def likely(c: str) -> Column:
        own = F.greatest(F.col(c) - rule.discount, F.lit(0.0)) / F.greatest(F.col(f"all_{c}"), F.lit(1))
        return own + freed(c) * F.col("p")
    rows = rows.withColumns({"usual": likely("ordinary"), "unseen": F.log(freed("toxic")) - F.log(freed("ordinary"))})
    rows = rows.withColumn("ratio", F.log(likely("toxic")) - F.log("usual"))
    rest = F.greatest(1 - _of_context(F.sum("usual")), F.lit(0.0))
    centre = _of_context(F.sum(F.col("usual") * F.col("ratio"))) + rest * F.col("unseen")
    rows = stored(rows.withColumn("centre", centre).select(
        "gram", "context", (F.col("ratio") - F.col("centre")).cast("float").alias("value"), "n",
        (F.col("unseen") - F.col("centre")).cast("float").alias("other"),
        (F.col("gram") == _of_context(F.min("gram"))).alias("first"),
        _of_context(F.sum("n")).alias("all")), "ratios")
    return (rows.select(F.col("gram").alias("key"), "value", F.col("n").alias("many")),
            rows.filter("first").select(F.col("context").alias("key"), F.col("other").alias("value"), F.col("all").alias("many")))


# ---- the tables that tasks get ----

KEY_BITS = U64(ORDER * BITS)


def _spread(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Cell of a key, and what tells it from the other keys of the cell: together a one-to-one map of 48 bits."""
    low = (U64(1) << KEY_BITS) - U64(1)
    x = keys.view(U64)
    x = ((x ^ (x >> U64(25))) * U64(0xBF58476D1CE4E5B9)) & low
    x = ((x ^ (x >> U64(23))) * U64(0x94D049BB133111EB)) & low
    x = x ^ (x >> U64(24))
    return (x & U64((1 << bits) - 1)).astype(np.int64), x >> U64(bits)


HELD, SHARED = 1, 2  # marks of a cell, below the rest of its key


class Cells:
    """A hash table of fixed size from keys to values. A shared cell has more keys than the one it holds.

    The blocks of cells that hold something stay as the tasks packed them; the driver hands them on without unpacking them.
    """

    def __init__(self, bits: int, blocks: dict[int, bytes] | None = None):
        self.bits, self.blocks, self._open = bits, blocks or {}, None

    def __getstate__(self) -> tuple:
        return self.bits, self.blocks

    def __setstate__(self, state: tuple):
        self.__init__(*state)
        self._open = self._unpacked()
        self.blocks = {}

    @property
    def size(self) -> int:
        """Bits of a cell's place in its block."""
        return min(self.bits, BLOCK_BITS)

    @property
    def kind(self) -> type:
        return np.uint32 if ORDER * BITS - self.bits <= 30 else U64

    def _unpacked(self) -> tuple[np.ndarray, np.ndarray]:
        value, mark = np.zeros(1 << self.bits, np.float16), np.zeros(1 << self.bits, self.kind)
        for block, packed in self.blocks.items():
            at, data = slice(block << self.size, (block + 1) << self.size), inflate(packed)
            value[at] = np.frombuffer(data, np.float16, 1 << self.size)
            mark[at] = np.frombuffer(data, self.kind, offset=value.itemsize << self.size)
        return value, mark

    def look(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Value of every key, whether the cell holds the key, and whether it may be among those the cell does not hold."""
        if self._open is None:
            self._open = self._unpacked()
        cell, rest = _spread(keys, self.bits)
        mark = self._open[1][cell].astype(U64)
        seen = ((mark & U64(HELD)) > 0) & (mark >> U64(2) == rest)
        return self._open[0][cell], seen, ~seen & ((mark & U64(SHARED)) > 0)

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Value of every key, and whether the table holds the key."""
        return self.look(keys)[:2]


def cells(entries: DataFrame, bits: int) -> Cells:
    """The table of (key, value, many), put together block by block on Spark."""
    size, kind = Cells(bits).size, Cells(bits).kind

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            cell, rest = _spread(part["key"].to_numpy(np.int64), bits)
            yield pd.DataFrame({"block": cell >> size, "cell": cell & ((1 << size) - 1), "rest": rest.astype(np.int64),
                                "value": part["value"], "many": part["many"], "key": part["key"]})
    rows = entries.mapInPandas(placed, "block LONG, cell LONG, rest LONG, value FLOAT, many LONG, key LONG")
    # One shuffle for both: rows dealt by block are dealt by block and cell.
    best = rows.repartition("block").groupBy("block", "cell").agg(
        F.max_by(F.struct("rest", "value"), F.struct("many", "key")).alias("held"),
        F.when(F.count(F.lit(1)) > 1, SHARED + HELD).otherwise(HELD).alias("marks"))

    def packed(part: pd.DataFrame) -> pd.DataFrame:
        value, mark = np.zeros(1 << size, np.float16), np.zeros(1 << size, kind)
        value[part["cell"]] = part["value"]
        mark[part["cell"]] = (part["rest"].to_numpy(np.int64) << 2) | part["marks"].to_numpy(np.int64)
        return pd.DataFrame({"block": [part["block"].iloc[0]], "cells": [deflate(value.tobytes() + mark.tobytes())]})
    blocks = best.select("block", "cell", "held.rest", "held.value", "marks").groupBy("block").applyInPandas(
        packed, "block LONG, cells BINARY")
    return Cells(bits, {row["block"]: bytes(row["cells"]) for row in blocks.toLocalIterator()})


@dataclass
class Model:
    grams: Cells
    contexts: Cells
    mixed: float

    def ratios(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log-ratio of every symbol as far as the tables tell, and where n-gram or context may be in the rest."""
        value, seen, gram_open = self.grams.look(code)
        other, known, context_open = self.contexts.look(code >> BITS)
        ratio = np.where(seen, value, np.where(known, other, np.float16(0))).astype(np.float64)
        return ratio, gram_open, ~seen & context_open

    def gains(self, ratio: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return np.log1p(self.mixed * np.expm1(np.clip(np.add.reduceat(ratio, starts), -30, 30)))

    def per_word(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Difference of the log-likelihoods of every text, divided by its words, as far as the tables tell; 0 without words."""
        code, starts, text = spelled(data, offsets)
        n = len(offsets) - 1
        if not len(code):
            return np.zeros(n)
        gain = self.gains(self.ratios(code)[0], starts)
        return np.bincount(text, gain, n) / np.maximum(np.bincount(text, minlength=n), 1)


# ---- what the tables do not hold ----

def _rest(grams: DataFrame, contexts: DataFrame, sent) -> DataFrame:
    """entry (twice the key, one more for a context) and value of what the tables of the model do not hold."""
    def left(which: str, add: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in batches:
                key = part.column("key").to_numpy()
                out = ~getattr(sent.value, which)(key)[1]
                value = part.column("value").to_numpy()[out].astype(np.float16).astype(np.float32)  # as in a cell
                yield pa.RecordBatch.from_arrays([pa.array(key[out] * 2 + add), pa.array(value)], ["entry", "value"])
        return run
    schema = "entry BIGINT, value FLOAT"
    return stored(grams.select("key", "value").mapInArrow(left("grams", 0), schema).unionByName(
        contexts.select("key", "value").mapInArrow(left("contexts", 1), schema)), "rest")


def evidence(rows: DataFrame, kept: list[str], sent, mixed: float, rest: DataFrame) -> DataFrame:
    """kept, and x: difference of the log-likelihoods of every text, divided by its words (0 without words).

    The tables settle nearly all words where the texts are. A word that they leave open is looked up once, whatever the
    number of texts that hold it, by its symbols. ``mixed`` is the model's: the driver does not read what it sent.
    """
    fields = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, at = sent.value, TaskContext.get().partitionId() << 40
        for part in pieces(batches, "text", CHUNK):
            n = part.num_rows
            code, starts, text = spelled(*text_bytes(part.column("text")))
            gain, open_ = np.zeros(n), [None] * n
            if len(code):
                ratio, gram, context = model.ratios(code)
                left = np.logical_or.reduceat(gram | context, starts)
                gain = np.bincount(text, np.where(left, 0.0, model.gains(ratio, starts)), n)
                symbols, ends = (code & ((1 << BITS) - 1)).astype(np.uint8), np.append(starts[1:], len(code))
                for w in np.flatnonzero(left).tolist():
                    open_[text[w]] = (open_[text[w]] or []) + [symbols[starts[w]: ends[w]].tobytes()]
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in kept], pa.array(np.arange(at, at + n)), pa.array(gain),
                 pa.array(np.bincount(text, minlength=n)), pa.array(open_, pa.list_(pa.binary()))],
                [*kept, "_row", "_gain", "_n", "_open"])
            at += n
    first = stored(rows.select(*kept, "text").mapInArrow(
        read, ", ".join([*fields, "_row BIGINT, _gain DOUBLE, _n BIGINT, _open ARRAY<BINARY>"])), "evidence")
    words = first.select("_row", F.explode("_open").alias("word"))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for part in pieces(batches, "word", CHUNK):
            said = part.column("word").cast(pa.large_binary())
            _, at, data = said.buffers()
            at = np.frombuffer(at, np.int64)[said.offset: said.offset + len(said) + 1]
            code = coded(np.frombuffer(data, np.uint8)[at[0]: at[-1]].astype(np.int64), at[:-1] - at[0])
            ratio, gram, context = model.ratios(code)
            # Sure ones of a word come as one row; an entry that nothing has is negative.
            open_ = np.flatnonzero(gram | context)
            sure = np.add.reduceat(np.where(gram | context, 0.0, ratio), at[:-1] - at[0])
            word = np.searchsorted(at[:-1] - at[0], open_, "right") - 1
            none = np.full(len(sure), -1) - np.arange(len(sure))
            keys = [np.where(gram, code * 2, -1 - code)[open_], np.where(context, (code >> BITS) * 2 + 1, -1 - code)[open_]]
            yield pa.RecordBatch.from_arrays(
                [said.take(pa.array(np.append(word, np.arange(len(sure))))).cast(pa.binary()),
                 *[pa.array(np.append(k, none)) for k in keys], pa.array(np.append(ratio[open_], sure))],
                ["word", "gram", "context", "ratio"])
    asked = words.select("word").distinct().mapInArrow(spell, "word BINARY, gram BIGINT, context BIGINT, ratio DOUBLE")
    for kind in ("gram", "context"):
        asked = asked.join(rest.select(F.col("entry").alias(kind), F.col("value").alias(f"of_{kind}")), kind, "left")
    word = F.sum(F.coalesce("of_gram", "of_context", "ratio"))
    gain = F.log1p(mixed * F.expm1(F.greatest(F.least(word, F.lit(30.0)), F.lit(-30.0))))
    gains = stored(asked.groupBy("word").agg(gain.alias("gain")), "open-words")
    more = words.join(gains, "word").groupBy("_row").agg(F.sum("gain").alias("_more"))
    per_word = (F.col("_gain") + F.coalesce("_more", F.lit(0.0))) / F.greatest("_n", F.lit(1))
    closed = first.filter("_open IS NULL").withColumn("_more", F.lit(0.0)).drop("_open").unionByName(
        first.filter("_open IS NOT NULL").drop("_open").join(more, "_row"))
    return closed.select(*kept, per_word.alias("x"))


@dataclass
class Scorer:
    """A model (broadcast), what its tables do not hold, and the curve that makes probabilities; without a model every score
    is `share`."""

    model: Broadcast | None
    slope: float = 0.0
    shift: float = 0.0
    share: float = 0.0
    rest: DataFrame | None = None
    mixed: float = 0.0

    def probability(self, x: Column) -> Column:
        bend = F.greatest(F.least(self.slope * bent(x) + self.shift, F.lit(500.0)), F.lit(-500.0))
        return 1 / (1 + F.exp(-bend))


def bent(x: Column) -> Column:
    return F.log(F.greatest(x, F.lit(0.0)) + 0.01)


def curve(x: np.ndarray, positive: np.ndarray, many: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through counted points, lightly held back."""
    whole = many.sum()
    centre = float((x * many).sum() / whole)
    width = max(float(np.sqrt((((x - centre) ** 2) * many).sum() / whole)), 1e-6)
    z, a, b = (x - centre) / width, 1.0, 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -500, 500)))
        slope = np.array([(z * (many * p - positive)).sum() / whole + 1e-3 * a, (many * p - positive).sum() / whole])
        w = many * p * (1 - p) / whole
        bend = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(bend, slope), -1, 1)
        a, b = a - step[0], b - step[1]
    return a / width, b - a * centre / width


def train(docs: DataFrame, labels: DataFrame, rule: Rule | None = None, *, key: str = "doc_id", text: str = "text",
          label: str = "toxic") -> Scorer:
    """Learn from every labelled document."""
    rule = rule or Rule()
    known = stored(labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(
        F.col(key).cast("long").alias("_key")).agg(F.max(F.col(label).cast("int")).alias("toxic")), "toxic-labels")
    for_curve = F.pmod(F.xxhash64(F.lit("curve"), F.col("_key")), F.lit(6)) == 0
    rows = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("text")).join(known, "_key").select(
        "text", "toxic", for_curve.alias("for_curve"))
    counts = _ngrams(rows.filter(~F.col("for_curve")))
    toxic, ordinary, labelled, marked = (int(n or 0) for n in (
        *counts.agg(F.sum("toxic"), F.sum("ordinary")).first(), *known.agg(F.count(F.lit(1)), F.sum("toxic")).first()))
    if not toxic or not ordinary:
        return Scorer(None, share=marked / max(labelled, 1))
    grams, contexts = log_ratios(counts, rule)
    model = Model(cells(grams, rule.cells), cells(contexts, rule.cells - 1), rule.mixed)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # once: every executor keeps a file of it

    rest = _rest(grams, contexts, sent)

    def points(on: DataFrame) -> pd.DataFrame:
        return evidence(on, ["toxic"], sent, rule.mixed, rest).groupBy(F.round(bent(F.col("x")), 3).alias("x")).agg(
            F.sum("toxic").alias("positive"), F.count(F.lit(1)).alias("many")).toPandas().sort_values("x")
    seen = points(rows.filter("for_curve"))
    if not 0 < seen["positive"].sum() < seen["many"].sum():
        seen = points(rows)  # too few rows were set aside to hold both classes
    return Scorer(sent, *curve(*[seen[c].to_numpy(float) for c in ("x", "positive", "many")]), rest=rest, mixed=rule.mixed)


def score(docs: DataFrame, scorer: Scorer, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and score of every row."""
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("text"))
    if scorer.model is None:
        return rows.select(F.col("_key").alias(key), F.lit(float(scorer.share)).alias("score"))
    found = evidence(rows, ["_key"], scorer.model, scorer.mixed, scorer.rest)
    return found.select(F.col("_key").alias(key), scorer.probability(F.col("x")).alias("score"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; learned from labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scorer = train(docs, table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id"))))
    return score(docs, scorer).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
