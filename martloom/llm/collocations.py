"""Phrase collocations by Rabin-Karp fingerprints.

1. Words get the polynomial hash of their bytes, phrases that of their words: prefix sums over a chunk of text give the fingerprint of
   every n-gram by one subtraction. Within a chunk each distinct fingerprint is sent once, with its number of occurrences; the
   shuffle adds the numbers up.
2. Lengths are mined in turn, since a phrase occurs no more often than its parts: two-word phrases of frequent words,
   then longer ones of frequent two-word phrases. What is frequent is told to the tasks as a bitmap over the low bits of the
   fingerprints, of a fixed size whatever the data; a bit shared by chance only lets an infrequent phrase through.
3. The last pass groups the occurrences of possibly frequent phrases by fingerprint, keeps a pointer to the first occurrence
   of each, and compares the words of every other occurrence with those at the pointer; occurrences that differ are counted apart. Only
   then a phrase becomes text, once a chunk, and the shuffle adds up by the text itself. Counts are exact: a
   collision of fingerprints can let a phrase through to this pass, and never joins two phrases or loses one.

Cases: a null text is empty; a null language is `und`, the same as a language of that name; texts of any length are read
whole; blanks between words do not matter, so a phrase is joined by single spaces; ties of a cut go to the shorter first part,
ties of score and frequency to the smaller phrase in byte order; repeated rows count each time; ids are not read, so null and
repeated ids do not matter; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.llm.common import U64, WORD_BASE, mix, pieces, prefix_sums, stored, stretch, table, text_bytes, word_hashes, words

CHUNK = 4 << 20
MAP_BITS = 27  # a bitmap of 16 MiB
BUCKET_BITS = 15  # of bitmap_construct_agg
LONGEST = 4


@dataclass(frozen=True)
class Rule:
    """Least occurrences, the share of a longer phrase that drops a phrase inside it (in 100), and the size of the report."""

    least: int = 30
    inside: int = 80
    top: int = 2000


_IS_END = np.zeros(256, bool)
_IS_END[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = True
_IS_GAP = _IS_END.copy()
_IS_GAP[[0x20, 0x09]] = True


class Chunk:
    """Words of some texts: where they stand, their language, exact numbers and fingerprints of phrases."""

    def __init__(self, texts: pa.Array, langs: list[str | None]):
        data, offsets = text_bytes(texts)
        data = data.copy()
        data[(data >= 65) & (data <= 90)] += 32
        gap = _IS_GAP[data]
        self.starts, ends, first = words(data, offsets, gap)
        self.n = len(self.starts)
        self.langs = [x if x is not None else "und" for x in langs]
        self.of_text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        piece = np.searchsorted(np.flatnonzero(_IS_END[data]), self.starts)
        # True where a word and the next one stand in one piece.
        self.goes_on = (self.of_text[1:] == self.of_text[:-1]) & (piece[1:] == piece[:-1])
        letters = np.concatenate([[0], np.cumsum(ends - self.starts)]).astype(np.int64)
        self.words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), self.n, [None, pa.py_buffer(letters), pa.py_buffer(np.ascontiguousarray(data[~gap]))])
        self.sums = prefix_sums(word_hashes(data, self.starts, ends), WORD_BASE)
        seeds = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in set(self.langs)}
        self.seed = np.array([seeds[x] for x in self.langs], U64)

    def fingerprints(self, at: np.ndarray, length: int) -> np.ndarray:
        """Of the phrases of `length` words that start at the words `at`, apart for every language."""
        whole = stretch(self.sums, at, at + length, WORD_BASE)
        return mix(mix(whole + U64(length)) ^ self.seed[self.of_text[at]]).view(np.int64)

    def all_of(self, length: int) -> np.ndarray:
        """Words at which a phrase of the length fits into its piece."""
        if self.n < length:
            return np.zeros(0, np.int64)
        fits = np.ones(self.n - length + 1, bool)
        for j in range(length - 1):
            fits &= self.goes_on[j: j + len(fits)]
        return np.flatnonzero(fits)


def _in_map(bitmap: np.ndarray, prints: np.ndarray) -> np.ndarray:
    bit = (prints.view(U64) & U64((1 << MAP_BITS) - 1)).astype(np.int64)
    return (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def bitmap_of(prints: DataFrame) -> np.ndarray:
    """The low bits of the fingerprints that occur, as a bitmap of fixed size."""
    bit = F.pmod(F.col("print"), F.lit(1 << MAP_BITS))
    parts = prints.select(F.shiftright(bit, BUCKET_BITS).cast("int").alias("bucket"),
                          F.pmod(bit, F.lit(1 << BUCKET_BITS)).alias("bit")).groupBy("bucket").agg(
        F.bitmap_construct_agg("bit").alias("bits"))
    out = np.zeros(1 << (MAP_BITS - 3), np.uint8)
    size = 1 << (BUCKET_BITS - 3)
    for row in parts.toLocalIterator():
        out[row["bucket"] * size: (row["bucket"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return out


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    for part in pieces(batches, "text", CHUNK):
        yield Chunk(part.column("text"), part.column("lang").to_pylist())


def frequent_prints(texts: DataFrame, least: int, prints: Callable[[Chunk], list[np.ndarray]]) -> DataFrame:
    """print: fingerprints that occur often enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            for found in prints(chunk):
                values, many = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(many.astype(np.int64))], ["print", "many"])
    counted = texts.mapInArrow(run, "print BIGINT, many BIGINT").groupBy("print").agg(F.sum("many").alias("many"))
    return stored(counted.filter(F.col("many") >= least).select("print"), "prints")


def _longer(chunk: Chunk, pairs: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Phrases of three words and more of which every two neighbours may be frequent: length, first words."""
    good = np.zeros(max(chunk.n - 1, 0), bool)
    at = chunk.all_of(2)
    good[at[_in_map(pairs, chunk.fingerprints(at, 2))]] = True
    out = []
    for length in range(3, LONGEST + 1):
        if chunk.n >= length:
            fits = np.ones(chunk.n - length + 1, bool)
            for j in range(length - 1):
                fits &= good[j: j + len(fits)]
            out.append((length, np.flatnonzero(fits)))
    return out


def _counted(chunk: Chunk, numbers: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First occurrence of every distinct phrase among those at `at`, and how often each occurs."""
    firsts, many = [], []
    while len(at):
        _, first, which, times = np.unique(
            chunk.fingerprints(at, length), return_index=True, return_inverse=True, return_counts=True)
        pointer = at[first]
        same = np.array([chunk.langs[t] for t in chunk.of_text[at]], object) == np.array(
            [chunk.langs[t] for t in chunk.of_text[pointer]], object)[which]
        for j in range(length):
            same &= numbers[at + j] == numbers[pointer[which] + j]
        firsts.append(pointer)
        many.append(np.bincount(which[same], minlength=len(pointer)))
        at = at[~same]  # collided with another phrase: counted on its own
    return np.concatenate(firsts or [np.zeros(0, np.int64)]), np.concatenate(many or [np.zeros(0, np.int64)])


PHRASES = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("many", pa.int64())])


def phrase_counts(texts: DataFrame, rule: Rule) -> DataFrame:
    """lang, phrase, words, many of every phrase that is frequent; with no phrase, the words of the language."""
    ones = bitmap_of(frequent_prints(texts, rule.least, lambda c: [c.fingerprints(c.all_of(1), 1)]))

    def two(chunk: Chunk) -> list[np.ndarray]:
        good = _in_map(ones, chunk.fingerprints(chunk.all_of(1), 1))
        at = chunk.all_of(2)
        return [chunk.fingerprints(at[good[at] & good[at + 1]], 2)]
    pairs = bitmap_of(frequent_prints(texts, rule.least, two))
    more = bitmap_of(frequent_prints(
        texts, rule.least, lambda c: [c.fingerprints(at, length) for length, at in _longer(c, pairs)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            encoded = chunk.words.dictionary_encode()
            numbers, spelled = encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary.cast(pa.large_string())
            wholes = np.bincount(chunk.of_text, minlength=len(chunk.langs))
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunk.langs, pa.string()), pa.nulls(len(wholes), pa.string()),
                 pa.array(np.zeros(len(wholes), np.int32)), pa.array(wholes.astype(np.int64))], schema=PHRASES)
            first = chunk.all_of(1)
            at_two = chunk.all_of(2)
            found = [(1, first[_in_map(ones, chunk.fingerprints(first, 1))]),
                     (2, at_two[_in_map(pairs, chunk.fingerprints(at_two, 2))])]
            found += [(length, at[_in_map(more, chunk.fingerprints(at, length))]) for length, at in _longer(chunk, pairs)]
            for length, at in found:
                pointer, many = _counted(chunk, numbers, at, length)
                spelt = [spelled.take(pa.array(numbers[pointer + j])) for j in range(length)]
                text = pc.binary_join_element_wise(*spelt, pa.scalar(" ", pa.large_string()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk.langs[t] for t in chunk.of_text[pointer]], pa.string()), text.cast(pa.string()),
                     pa.array(np.full(len(pointer), length, np.int32)), pa.array(many.astype(np.int64))], schema=PHRASES)
    counted = texts.mapInArrow(run, "lang STRING, phrase STRING, words INT, many BIGINT").groupBy("lang", "phrase").agg(
        F.max("words").alias("words"), F.sum("many").alias("many"))
    return counted.filter(F.col("phrase").isNull() | (F.col("many") >= rule.least))


def _wide(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")


def collocations(docs: DataFrame, rule: Rule | None = None, *, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best-bound phrases of two to four words of every language."""
    rule = rule or Rule()
    texts = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    known = stored(phrase_counts(texts, rule), "phrases")
    sizes = known.filter(F.col("phrase").isNull()).select("lang", F.col("many").alias("n"))
    known = known.filter(F.col("phrase").isNotNull())
    candidates = known.filter(F.col("words") >= 2)

    def part(start: Column, length: Column) -> Column:
        return F.array_join(F.slice(F.split("phrase", " "), start, length), " ")
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1))
    cuts = candidates.withColumn("k", cut).select(
        "lang", "phrase", F.col("many").alias("a"), "k", part(F.lit(1), F.col("k")).alias("_first"),
        part(F.col("k") + 1, F.col("words") - F.col("k")).alias("_rest"))
    firsts = known.select("lang", F.col("phrase").alias("_first"), F.col("many").alias("l"))
    rests = known.select("lang", F.col("phrase").alias("_rest"), F.col("many").alias("r"))
    score = F.expr("(CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(20,0))) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    scored = cuts.join(firsts, ["lang", "_first"]).join(rests, ["lang", "_rest"]).withColumn("score", score)
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("_cut")).select(
        "lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score")

    length = F.explode(F.sequence(F.lit(2), F.col("words") - 1))
    inner = candidates.filter(F.col("words") > 2).withColumn("k", length).withColumn(
        "_from", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("k") + 1))
    ).select("lang", part(F.col("_from"), F.col("k")).alias("phrase"), "many").groupBy("lang", "phrase").agg(
        F.max("many").alias("_longer"))
    own = lowest.join(inner, ["lang", "phrase"], "left").filter(
        F.col("_longer").isNull() | (_wide("_longer") * 100 < _wide("a") * rule.inside))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = own.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= rule.top)
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases of all documents that occur 30 times and more, per language."""
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))


SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL
), lists AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), sizes AS (
    SELECT coalesce(lang, 'und') AS lang, sum(len(w))::BIGINT AS n FROM lists GROUP BY 1
), grams AS (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM lists, (VALUES (1), (2), (3), (4)) AS lengths(k) WHERE len(w) >= k
), known AS (
    SELECT lang, phrase, max(k) AS k, count(*) AS a FROM grams GROUP BY lang, phrase HAVING count(*) >= 30
), cuts AS (
    SELECT lang, phrase, a, c, string_split(phrase, ' ') AS w
    FROM known, (VALUES (1), (2), (3)) AS places(c) WHERE k >= 2 AND c < k
), scored AS (
    SELECT cuts.*, x.a AS l, y.a AS r, ((2000000::HUGEINT * cuts.a) // (x.a + y.a))::BIGINT AS score
    FROM cuts JOIN known x ON x.lang = cuts.lang AND x.phrase = array_to_string(w[1:c], ' ')
    JOIN known y ON y.lang = cuts.lang AND y.phrase = array_to_string(w[c + 1:], ' ')
), lowest AS (
    SELECT lang, phrase, a, l, r, score FROM scored
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
), kept AS (
    SELECT * FROM lowest WHERE NOT EXISTS (
        SELECT 1 FROM known z WHERE z.lang = lowest.lang AND z.k > 2 AND len(z.phrase) > len(lowest.phrase)
        AND contains(' ' || z.phrase || ' ', ' ' || lowest.phrase || ' ') AND 100::HUGEINT * z.a >= 80::HUGEINT * lowest.a)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN sizes USING (lang) QUALIFY rank <= 2000
"""
