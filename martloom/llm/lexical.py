"""Ranked lexical search over bit-sliced Bloom signatures.

1. Every whole text becomes the set of its terms and, for terms that occur several times, of marks "this term at least so
   often". The marks go into a Bloom signature. Signatures of documents of like size are laid side by side in pages and
   cut into slices: one bitmap over the rows of the page for each bit of the signature. The pages are a stored table.
2. For a block of queries, the slices of a term are ANDed. The rows left hold the term, or seem to: presence is only ever
   overestimated, and so is the number of occurrences. Weights summed over the slices bound each row's score from above.
3. The documents with the highest bounds are scored on their texts; the lowest of the best scores is each query's
   threshold. Every document whose bound reaches the threshold, that is every one not provably excluded, is then scored on
   its text. Scores come from texts alone, so the result is exact whatever the signatures say.

Queries meet all documents in blocks of `block_bytes` of query text; a block travels to the tasks with the code, and nothing
that grows with the documents leaves Spark's tables.

A term is a maximal run of characters other than ASCII ones that are neither digit nor letter; A-Z are lower-cased. A document's
score for a query sums w * ((1000000000 * tf) div (1000 * tf + 8 * m)) over the query's terms, as `Ranking` tells.

Cases: null and empty texts have no terms; they count in no statistic and rank nowhere, and such a query finds nothing. Very
long texts are read whole. Ties go to the smaller id; a null id ranks after all others of its score. Rows that share an id are
documents of their own; equal query rows are one query, rows that share an id but not the text are two. Empty tables
give an empty result. Extra columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.llm.common import U64, mix, pieces, stored, table

SCALE = 1_000_000_000
# Occurrence marks: a document with tf occurrences of a term carries a mark for every entry that tf reaches.
MARKS = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 64, 128, 512)
HASHES = 6
BITS_PER_MARK = 16
PAGE_BITS = 1 << 22
TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@dataclass(frozen=True)
class Ranking:
    """How many documents a query returns, and the constants of the score.

    w = floor(1000 * ln((2N + 2) / (2df + 1))); m = 100 - length + (length * n * N) div L; a term adds
    w * ((10^9 * tf) div (1000 * tf + saturation * m)).
    """

    top: int = 10
    length: int = 75
    saturation: int = 8
    block_bytes: int = 1 << 20


def term_counts(text: str | None) -> Counter[bytes]:
    """Terms of a text with their occurrences."""
    return Counter(text.encode("utf-8", "surrogatepass").translate(TERM_BYTES).split()) if text else Counter()


# ---- the index ----

def _places(crc: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of a term's mark; the places of a signature are their arithmetic progression."""
    spread = mix(crc.astype(U64) * U64(len(MARKS) + 1) + mark.astype(U64) + U64(1))
    return spread & U64(0xFFFFFFFF), (spread >> U64(32)) | U64(1)


def _bits(crc: np.ndarray, mark: np.ndarray, width: int) -> np.ndarray:
    """Positions in a signature of `width` bits (a power of two): one row per mark, HASHES columns."""
    first, step = _places(crc, mark)
    return ((first[:, None] + step[:, None] * np.arange(HASHES, dtype=U64)) & U64(width - 1)).astype(np.int64)


def _page(rows: list[tuple[int | None, int, np.ndarray, np.ndarray]], width: int) -> dict:
    bits = np.zeros((width, len(rows)), bool)
    for at, (_, _, crc, mark) in enumerate(rows):
        bits[_bits(crc, mark, width).ravel(), at] = True
    return {"ids": [r[0] for r in rows], "lengths": [r[1] for r in rows], "width": width,
            "slices": np.packbits(bits, axis=1).tobytes()}


PAGE_TYPE = pa.schema([("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("width", pa.int64()),
                       ("slices", pa.binary())])
PAGE_DDL = "ids ARRAY<BIGINT>, lengths ARRAY<BIGINT>, width BIGINT, slices BINARY"


def index(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Pages of bit slices over all documents that hold a term: ids, lengths (terms with repeats), width, slices."""
    marks = np.array(MARKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text"):
            by_width: dict[int, list] = {}
            for doc, whole in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
                counts = term_counts(whole)
                if not counts:
                    continue
                crc = np.fromiter((zlib.crc32(t) for t in counts), np.int64, len(counts))
                times = np.fromiter(counts.values(), np.int64, len(counts))
                reach = np.searchsorted(marks, times, "right")
                width = 1 << max(6, int(int(reach.sum()) * BITS_PER_MARK - 1).bit_length())
                ends = np.cumsum(reach)
                mark = np.arange(ends[-1]) - np.repeat(ends - reach, reach)
                by_width.setdefault(width, []).append((doc, int(times.sum()), np.repeat(crc, reach), mark))
            found = []
            for width, rows in by_width.items():
                most = max(8, PAGE_BITS // width)
                found += [_page(rows[i: i + most], width) for i in range(0, len(rows), most)]
            if found:
                yield pa.RecordBatch.from_pylist(found, PAGE_TYPE)
    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(run, PAGE_DDL)


# ---- a block of queries ----

@dataclass(frozen=True)
class Block:
    """Queries with their terms as numbers, and the weights of the terms that occur in the documents."""

    names: list[int | None]
    terms: dict[bytes, int]
    weights: np.ndarray
    parts: list[tuple[np.ndarray, np.ndarray]]  # per query: its terms and their repeats
    documents: int
    length: int
    ranking: Ranking

    def norm(self, n: np.ndarray) -> np.ndarray:
        r = self.ranking
        return 100 - r.length + (r.length * n * self.documents) // self.length

    def bounds(self, page: dict) -> tuple[np.ndarray, np.ndarray]:
        """Scores that the rows of a page cannot exceed: one row per query."""
        rows, width = len(page["ids"]), page["width"]
        slices = np.frombuffer(page["slices"], np.uint8).reshape(width, -1)
        crc = np.fromiter((zlib.crc32(t) for t in self.terms), np.int64, len(self.terms))
        norm = self.norm(np.array(page["lengths"], np.int64))
        # A row with marks 0..i holds the term fewer times than mark i + 1 says; beyond the last, the whole text.
        below = np.append(np.array(MARKS[1:]) - 1, 0)
        gains = np.zeros((len(crc), rows), np.int64)
        step = max(1, (1 << 21) // max(rows, 1))
        for a in range(0, len(crc), step):
            some = crc[a: a + step]
            at, row = np.nonzero(self._present(slices, some, 0, width, rows))
            level = np.zeros(len(at), np.int64)
            open_ = np.arange(len(at))
            for mark in range(1, len(MARKS)):
                if not len(open_):
                    break
                places = _bits(some[at[open_]], np.full(len(open_), mark), width)
                column = row[open_]
                held = ((slices[places, (column >> 3)[:, None]] >> (7 - (column & 7))[:, None]) & 1).all(1)
                open_ = open_[held]
                level[open_] = mark
            lengths = np.array(page["lengths"], np.int64)
            times = np.where(level == len(MARKS) - 1, lengths[row], np.minimum(below[level], lengths[row]))
            gains[a + at, row] = self.weights[a + at] * (SCALE * times // (1000 * times + self.ranking.saturation * norm[row]))
        return np.stack([(gains[t] * many[:, None]).sum(0) if len(t) else np.zeros(rows, np.int64)
                         for t, many in self.parts])

    @staticmethod
    def _present(slices: np.ndarray, crc: np.ndarray, mark: int, width: int, rows: int) -> np.ndarray:
        places = _bits(crc, np.full(len(crc), mark), width)
        left = slices[places[:, 0]].copy()
        for h in range(1, HASHES):
            left &= slices[places[:, h]]
        return np.unpackbits(left, axis=1, count=rows)

    def scores(self, text: str | None, wanted: list[int]) -> list[int]:
        """Exact scores of one text for some queries."""
        counts = term_counts(text)
        n = sum(counts.values())
        norm = int(self.norm(np.array([n]))[0]) if self.length else 100
        gain = np.zeros(len(self.terms), np.int64)
        for term, number in self.terms.items():
            tf = counts.get(term)
            if tf:
                gain[number] = int(self.weights[number]) * (SCALE * tf // (1000 * tf + self.ranking.saturation * norm))
        return [int((gain[self.parts[q][0]] * self.parts[q][1]).sum()) for q in wanted]


def document_counts(docs: DataFrame, text: str, terms: set[bytes]) -> dict[bytes, int]:
    """In how many documents each of a block's terms occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for whole in batch.column("text"):
                seen.update(terms & term_counts(whole.as_py()).keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen.keys()), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["term", "df"])
    found = docs.select(F.col(text).alias("text")).mapInArrow(run, "term BINARY, df BIGINT")
    return {bytes(r["term"]): r["df"] for r in found.groupBy("term").agg(F.sum("df").alias("df")).collect()}


def prepared(rows: list[tuple[int | None, str | None]], docs: DataFrame, text: str, size: tuple[int, int],
             ranking: Ranking) -> Block:
    counts = [term_counts(t) for _, t in rows]
    df = document_counts(docs, text, set().union(*counts)) if counts else {}
    terms = {t: i for i, t in enumerate(sorted(df))}
    weights = np.array([math.floor(1000 * math.log((2 * size[0] + 2) / (2 * df[t] + 1))) for t in terms], np.int64)
    parts = []
    for c in counts:
        held = [(terms[t], many) for t, many in c.items() if t in terms]
        parts.append((np.array([h[0] for h in held], np.int64), np.array([h[1] for h in held], np.int64)))
    return Block([r[0] for r in rows], terms, weights, parts, size[0], size[1], ranking)


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


CANDIDATES = "query INT, id BIGINT, bound BIGINT"


def _emit(query: np.ndarray, ids: list, bound: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(query, pa.int32()), pa.array(ids, pa.int64()), pa.array(bound, pa.int64())],
                                      ["query", "id", "bound"])


def highest_bounds(pages: DataFrame, block: Block) -> DataFrame:
    """The rows with the highest bounds of every query: as many per task and query as the query returns."""
    top = block.ranking.top

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int | None]]] = [[] for _ in block.names]
        for page in _pages(batches):
            bounds = block.bounds(page)
            some = min(top, bounds.shape[1])
            picks = np.argpartition(-bounds, some - 1, axis=1)[:, :some]
            for q, pick in enumerate(picks):
                best[q] = sorted(best[q] + [(int(bounds[q, i]), page["ids"][i]) for i in pick if bounds[q, i] > 0],
                                 key=lambda b: -b[0])[:top]
        rows = [(q, i, b) for q, held in enumerate(best) for b, i in held]
        yield _emit(np.array([r[0] for r in rows], np.int32), [r[1] for r in rows], np.array([r[2] for r in rows], np.int64))
    order = Window.partitionBy("query").orderBy(F.desc("bound"), F.asc_nulls_last("id"))
    return pages.mapInArrow(run, CANDIDATES).withColumn("place", F.row_number().over(order)).filter(
        F.col("place") <= top).drop("place")


def not_excluded(pages: DataFrame, block: Block, least: np.ndarray) -> DataFrame:
    """Every row whose bound reaches the threshold of a query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for page in _pages(batches):
            bounds = block.bounds(page)
            query, row = np.nonzero(bounds >= least[:, None])
            yield _emit(query.astype(np.int32), [page["ids"][i] for i in row], bounds[query, row])
    return pages.mapInArrow(run, CANDIDATES)


def exact(docs: DataFrame, candidates: DataFrame, block: Block, key: str, text: str) -> DataFrame:
    """query, id, score above 0 of the candidates, from whole texts."""
    wanted = candidates.groupBy("id").agg(F.collect_set("query").alias("queries"))
    texts = docs.select(F.col(key).cast("long").alias("_id"), F.col(text).alias("text"))
    met = texts.join(wanted, F.col("_id").eqNullSafe(F.col("id"))).select("id", "text", "queries")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text"):
            rows = []
            for doc, whole, queries in zip(*(part.column(c).to_pylist() for c in ("id", "text", "queries"))):
                rows += [(q, doc, s) for q, s in zip(queries, block.scores(whole, queries)) if s > 0]
            yield _emit(np.array([r[0] for r in rows], np.int32), [r[1] for r in rows],
                        np.array([r[2] for r in rows], np.int64))
    return met.mapInArrow(run, CANDIDATES).withColumnRenamed("bound", "score")


def _best(scored: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def blocks(queries: DataFrame, item: str, text: str, block_bytes: int) -> Iterator[list[tuple[int | None, str | None]]]:
    """Distinct queries, dealt into blocks of about `block_bytes` of text by a hash; a longer query is not cut."""
    rows = stored(queries.select(F.col(item).cast("long").alias("item"), F.col(text).alias("text")).distinct(), "queries")
    many = -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes)
    for b in range(many):
        found = rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(many)) == b).orderBy("item", "text").collect()
        if found:
            yield [(r["item"], r["text"]) for r in found]


def search(docs: DataFrame, queries: DataFrame, ranking: Ranking | None = None, *, key: str = "doc_id", text: str = "text",
           item: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the highest-scoring documents of every query (columns item and key as named)."""
    ranking = ranking or Ranking()
    pages = stored(index(docs, key, text), "slices")
    size = pages.agg(F.sum(F.size("ids").cast("long")), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n))).first()
    size = (size[0] or 0, size[1] or 0)
    spark, found = docs.sparkSession, []
    for rows in blocks(queries, item, item_text, ranking.block_bytes):
        block = prepared(rows, docs, text, size, ranking)
        if not block.terms:
            continue
        seeds = stored(highest_bounds(pages, block), "seeds")
        known = _best(exact(docs, seeds, block, key, text), ranking.top)
        known = known.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).collect()
        least = np.ones(len(rows), np.int64)
        for r in known:
            least[r["query"]] = r["least"] if r["n"] >= ranking.top else 1
        candidates = stored(not_excluded(pages, block, least), "candidates")
        names = F.array(*[F.lit(n).cast("long") for n in block.names])
        best = _best(exact(docs, candidates, block, key, text), ranking.top).select(
            F.get(names, F.col("query")).alias(item), "rank", F.col("id").alias(key), "score")
        found.append(stored(best, "ranked"))
    if not found:
        return spark.createDataFrame([], f"`{item}` BIGINT, rank INT, `{key}` BIGINT, score BIGINT")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents ranked for each benchmark item."""
    return search(table(spark, sf_dir, "documents").select("doc_id", "text"),
                  table(spark, sf_dir, "benchmark").select("item_id", "text"))


_TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = f"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '{_TERMS}')) AS term FROM documents
), asked AS (
    SELECT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERMS}')) AS term FROM benchmark
), lengths AS (
    SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id
), size AS (
    SELECT count(*) AS docs, sum(n)::BIGINT AS whole FROM lengths
), tfs AS (
    SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term
), weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM tfs, size GROUP BY term, docs
), gains AS (
    SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // whole))) AS gain
    FROM tfs JOIN weights USING (term) JOIN lengths USING (doc_id), size
), scored AS (
    SELECT item_id, doc_id, sum(gain)::BIGINT AS score FROM asked JOIN gains USING (term) GROUP BY item_id, doc_id
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""
