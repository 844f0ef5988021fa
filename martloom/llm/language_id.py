"""Language identification by prediction by partial matching.

For every language a variable-order tree of byte contexts holds how often each byte followed each context. A byte is
coded at the longest context that knows it; every shorter step pays the escape probability D / (N + D) of the context
left (N bytes seen there, D of them distinct), and a byte known nowhere costs 1/256 below order 0. Statistics are frozen
after training, so the code length of a text is an exact sum over its bytes, and the language with the shortest code wins.

Since nothing changes while coding, escapes are folded in once: each known (context, byte) holds the finished log
probability of all languages, and a whole batch of texts is coded by a few table look-ups per byte.

Training reads a bounded sample: about `sample_bytes` of text per language, drawn by a seeded hash of the id, whole texts
only, and at least one text that is not empty. Contexts seen less often than `min_count` are pruned.

Cases: a null text or one without a letter is `und` with score 0; with nothing to learn from, every text is; a null id
hashes as the empty text; a null language is not learned from; ties go to the language first in alphabet; very long
texts are coded whole; repeated rows are scored alike; other columns are kept out of the prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import U64, held_out, mix, pieces, table, text_bytes

ORDER = 4
UNKNOWN = "und"
# A text is in none of the languages if it takes more bits than the costliest training text (of LEAST_BYTES bytes or more),
# with MARGIN_BITS more for every byte, for words that training has not seen, and SLACK_BITS for the whole text.
LEAST_BYTES, MARGIN_BITS, SLACK_BITS = 200, 3.0, 600
COUNTS = "lang STRING, depth INT, gram BIGINT, n BIGINT"


class HashIndex:
    """Row numbers of integer keys, by open addressing; looks up whole arrays."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.mask = U64((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, U64)
        self.rows = np.full(1 << bits, -1, np.int32)
        waiting, step, home = np.arange(len(keys)), 0, mix(keys.astype(U64)) & self.mask
        while len(waiting):
            slot = ((home[waiting] + U64(step)) & self.mask).astype(np.int64)
            free = self.rows[slot] < 0
            _, first = np.unique(slot[free], return_index=True)
            put = waiting[free][first]
            at = slot[free][first]
            self.keys[at], self.rows[at] = keys[put], put
            waiting, step = np.setdiff1d(waiting, put, assume_unique=True), step + 1
        self.steps = max(step, 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        home = mix(keys) & self.mask
        slot = home.astype(np.int64)
        rows = self.rows[slot]
        wrong = np.flatnonzero((rows >= 0) & (self.keys[slot] != keys))
        for step in range(1, self.steps + 1):
            if not len(wrong):
                break
            slot = ((home[wrong] + U64(step)) & self.mask).astype(np.int64)
            found = self.rows[slot]
            rows[wrong] = found
            wrong = wrong[(found >= 0) & (self.keys[slot] != keys[wrong])]
        rows[wrong] = -1
        return rows


@dataclass
class Model:
    """Frozen statistics: per depth the known grams with log2 probabilities, and the contexts with log2 escapes.

    `most_bits` is the bits per byte beyond which a text is in none of the languages.
    """

    langs: list[str]
    grams: list[HashIndex]
    gram_bits: list[np.ndarray]
    contexts: list[HashIndex]
    escape_bits: list[np.ndarray]
    most_bits: float = 8.0


def grams_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every byte the integer of it and the ORDER bytes before it (line feeds before a text); and text starts."""
    n = len(offsets) - 1
    padded = np.full(len(data) + ORDER * n, 10, np.uint8)
    real = np.arange(len(data)) + ORDER * np.repeat(np.arange(1, n + 1), np.diff(offsets))
    padded[real] = data
    code = np.zeros(len(data), U64)
    for back in range(ORDER, -1, -1):
        code = (code << U64(8)) | padded[real - back].astype(U64)
    return code, offsets


def tail(code: np.ndarray, depth: int) -> np.ndarray:
    """The last depth + 1 bytes: the byte and its context of that depth."""
    return code & U64((1 << (8 * (depth + 1))) - 1)


def count_grams(sample: DataFrame, text: str = "text") -> DataFrame:
    """Grams of all depths per language, counted in each piece and summed by Spark."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, text):
            langs = np.asarray(part.column("lang").to_pylist(), object)
            for lang in sorted(set(langs)):
                rows = part.column(text).filter(pa.array(langs == lang))
                code, _ = grams_of(*text_bytes(pc.utf8_lower(rows)))
                for depth in range(ORDER + 1):
                    grams, n = np.unique(tail(code, depth), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(n), pa.string()), pa.array(np.full(len(n), depth, np.int32)),
                         pa.array(grams.astype(np.int64)), pa.array(n.astype(np.int64))],
                        ["lang", "depth", "gram", "n"])
    return sample.select("lang", text).mapInArrow(count, COUNTS).groupBy("lang", "depth", "gram").agg(
        F.sum("n").alias("n"))


def build(langs: list[str], depth: np.ndarray, gram: np.ndarray, lang: np.ndarray, n: np.ndarray) -> Model:
    """Fold the counts into finished log2 probabilities, from short contexts to long ones."""
    model, below = Model(langs, [], [], [], []), None
    for d in range(ORDER + 1):
        pick = depth == d
        keys, row = np.unique(gram[pick], return_inverse=True)
        seen = np.zeros((len(keys), len(langs)))
        np.add.at(seen, (row, lang[pick]), n[pick])
        contexts, of = np.unique(keys >> U64(8), return_inverse=True)
        total, kinds = np.zeros((len(contexts), len(langs))), np.zeros((len(contexts), len(langs)))
        np.add.at(total, of, seen)
        np.add.at(kinds, of, seen > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(total > 0, np.log2(kinds / (total + kinds)), 0.0)
            direct = np.log2(seen / (total + kinds)[of])
        shorter = np.full((len(keys), len(langs)), -8.0) if below is None else finish(model, tail(keys, d - 1), d - 1)
        bits = np.where(seen > 0, direct, escape[of] + shorter)
        model.grams.append(HashIndex(keys))
        model.gram_bits.append(bits.astype(np.float32))
        model.contexts.append(HashIndex(contexts))
        model.escape_bits.append(escape.astype(np.float32))
        below = d
    return model


def finish(model: Model, code: np.ndarray, depth: int) -> np.ndarray:
    """log2 probability of each byte in all languages, starting at contexts of a depth."""
    out = np.zeros((len(code), len(model.langs)), np.float32)
    left = None
    for d in range(depth, -1, -1):
        keys = tail(code if left is None else code[left], d)
        row = model.grams[d].find(keys)
        hit = row >= 0
        miss = np.flatnonzero(~hit)
        if left is None:
            out = model.gram_bits[d][row]
            out[miss] = 0
        else:
            out[left[hit]] += model.gram_bits[d][row[hit]]
        missed = miss if left is None else left[miss]
        context = model.contexts[d].find(keys[miss] >> U64(8))
        known = context >= 0
        out[missed[known]] += model.escape_bits[d][context[known]]
        left = missed
        if not len(left):
            return out
    out[left] -= 8.0
    return out


def train(
    docs: DataFrame, *, text: str = "text", key: str = "doc_id", sample_bytes: int = 1 << 20, min_count: int = 2,
    seed: int = 17,
) -> Model | None:
    """Learn from rows whose language is given. None if there is no such row."""
    known = docs.filter(F.col("lang").isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("key"), "lang", text)
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("key")), F.lit(1 << 30))
    place = F.struct(draw.alias("draw"), F.xxhash64(F.col(text)).alias("h"))
    sizes = {r["lang"]: r for r in known.groupBy("lang").agg(
        F.sum(F.octet_length(text)).alias("bytes"), F.min(F.when(F.col(text) != "", place)).alias("least")).collect()}
    if not sizes:
        return None
    drawn = F.lit(False)
    for lang, row in sizes.items():
        here = draw / float(1 << 30) < min(1.0, sample_bytes / max(row["bytes"], 1))
        if row["least"] is not None:  # the first in hash order always, or a language of a few long texts might get none
            here = here | ((draw == row["least"]["draw"]) & (F.xxhash64(F.col(text)) == row["least"]["h"]))
        drawn = F.when(F.col("lang") == lang, here).otherwise(drawn)
    sample = known.filter(drawn)
    langs = sorted(sizes)
    got = count_grams(sample, text).filter((F.col("n") >= min_count) | (F.col("depth") == 0))
    number = F.element_at(F.create_map(*[F.lit(x) for i, lang in enumerate(langs) for x in (lang, i)]), F.col("lang"))
    # Columns, not rows: a row of the counts is many times its numbers on the driver.
    got = got.select("depth", "gram", number.alias("at"), "n").toArrow()
    depth, gram, at, n = (got.column(c).to_numpy() for c in ("depth", "gram", "at", "n"))
    model = build(langs, depth, gram.astype(U64), at.astype(np.int64), n)
    own = predict(sample.select(F.col(text).alias("text")), model, text="text", names=("_lang", "_score", "_bits"))
    most = own.filter(F.octet_length("text") >= LEAST_BYTES).agg(F.max("_bits")).first()[0]
    model.most_bits = most + MARGIN_BITS if most is not None else model.most_bits
    return model


def code_lengths(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bits of every text in every language, and its bytes."""
    data, offsets = text_bytes(pc.utf8_lower(texts))
    code, _ = grams_of(data, offsets)
    bits = np.zeros((len(offsets) - 1, len(model.langs)))
    size = np.diff(offsets)
    some = np.flatnonzero(size > 0)
    for at in range(0, len(code), 1 << 19):  # a long text is summed over several steps
        end = min(at + (1 << 19), len(code))
        rows = some[(offsets[some] < end) & (offsets[some + 1] > at)]
        cost = finish(model, code[at:end], ORDER)
        bits[rows] -= np.add.reduceat(cost, np.maximum(offsets[rows] - at, 0), axis=0, dtype=np.float64)
    return bits, size


def predict(
    docs: DataFrame, model: Model | None, *, text: str = "text",
    names: tuple[str, str, str] = ("lang_pred", "score", "bits_per_byte"),
) -> DataFrame:
    """The columns of docs, then language, score (posterior under equal priors) and bits per byte of the winner.

    A column of docs that bears one of the three names is replaced.
    """
    pred, score, rate = names
    taken = {n.lower() for n in names}
    kept = [f for f in docs.schema.fields if f.name.lower() not in taken or f.name == text]
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return docs.select(*[F.col(f"`{f.name}`") for f in kept], F.lit(UNKNOWN).alias(pred), F.lit(0.0).alias(score),
                           F.lit(None).cast("double").alias(rate))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    flagged = docs.select(*[F.col(f"`{f.name}`") for f in kept], letters.alias("_has_letters"))
    schema = T.StructType([*kept, T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType()),
                           T.StructField(rate, T.DoubleType())])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for part in pieces(batches, text, 1 << 20):
            bits, size = code_lengths(known, part.column(text))
            has = part.column("_has_letters").to_numpy(zero_copy_only=False)
            best = bits.argmin(axis=1)
            least = bits[np.arange(len(best)), best]
            sure = 1.0 / np.exp2(np.minimum(0, least[:, None] - bits)).sum(axis=1)
            found = np.where(has, np.asarray(known.langs, object)[best], UNKNOWN)
            per_byte = np.where(size > 0, least / np.maximum(size, 1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [part.column(f.name) for f in kept] + [pa.array(found.tolist(), pa.string()),
                                                       pa.array(np.where(has, sure, 0.0)), pa.array(per_byte)],
                [*[f.name for f in kept], pred, score, rate])
    return flagged.mapInArrow(code, schema)


def keep_known(docs: DataFrame, model: Model | None, *, most_bits: float | None = None) -> DataFrame:
    """The rows of docs, with their columns, that are in a learned language.

    Texts without a letter go, and texts that even the best language codes at a cost that no training text comes near: more than
    the model's `most_bits` a byte and SLACK_BITS besides, so a short text with unseen words or names stays. `most_bits` puts a
    hard bound in its place. Without a model nothing can be told of a language, and all texts with a letter stay.
    """
    if model is None:
        return docs.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    scored = predict(docs, model, names=("_ppm_lang", "_ppm_score", "_ppm_bits"))
    bound = F.lit(model.most_bits) + SLACK_BITS / F.octet_length("text") if most_bits is None else F.lit(most_bits)
    return scored.filter((F.col("_ppm_lang") != UNKNOWN) & (F.col("_ppm_bits") <= bound)).select(
        *[F.col(f"`{c}`") for c in docs.columns])


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; learned from rows outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    return predict(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), model).select(
        "doc_id", "held_out", "lang_pred", "score", "bits_per_byte")
