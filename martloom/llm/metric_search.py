"""Exact top-k by inner product with a paged M-tree and best-first search.

Inner product becomes a metric by one more coordinate: with M the largest length in a block of vectors and x' the vector
(x, sqrt(M^2 - |x|^2)), the distance from (q, 0) to x' is sqrt(|q|^2 + M^2 - 2 q.x), so nearest is highest.

Vectors are dealt to blocks of bounded size; each block is bulk-loaded into a tree whose nodes hold a pivot, a covering
radius and the distance to the parent's pivot, and whose leaf pages hold vectors with their distance to the pivot. The
trees are stored as rows. Each tree meets each block of queries once; a query opens nodes in the order of their lower
bound, skips children and page entries whose stored distances rule them out by the triangle inequality before computing
anything, and stops when the nearest open bound is beyond its k-th best. Scores are exact integers, bounds have slack,
and ties go to the smaller id, so the result equals a full scan.

Cases: vectors that are null, or hold null or non-finite components, take no part; vectors meet queries of their own
length only; identical rows count once; rows that share an id but not a vector are separate candidates, and a query
never meets its own id; fewer than k candidates give fewer rows; null ids take no part; an empty table gives an empty result.
Components are exact up to 2**20 in size.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.llm.common import stored, table

PAGE, FANOUT = 256, 16
BLOCK_ROWS, QUERY_ROWS = 8192, 2048


class Tree:
    """Nodes as arrays; entries of a leaf stand together."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        norms = (vectors * vectors).sum(1)
        self.top = float(norms.max(initial=0.0))
        lifted = np.column_stack([vectors, np.sqrt(np.maximum(self.top - norms, 0.0))])
        self.pivot, self.radius, self.to_parent, self.children, self.span = [], [], [], [], []
        order: list[np.ndarray] = []
        self._filled = 0
        self._grow(np.arange(len(ids)), lifted, 0.0, None, order)
        order = np.concatenate(order) if order else np.zeros(0, int)
        self.ids, self.vectors = ids[order], vectors[order]
        self.to_pivot = np.zeros(len(order))
        for node, span in enumerate(self.span):
            if span:
                at = order[span[0]: span[1]]
                self.to_pivot[span[0]: span[1]] = np.linalg.norm(lifted[at] - lifted[self.pivot[node]], axis=1)
        self.pivot = vectors[np.array(self.pivot, int)]
        self.radius, self.to_parent = np.array(self.radius), np.array(self.to_parent)
        self.children = [np.array(c, int) for c in self.children]

    def _grow(self, rows, lifted, to_parent, pivot, order) -> int:
        pivot = int(rows[0]) if pivot is None else pivot
        node = len(self.radius)
        self.pivot.append(pivot)
        self.to_parent.append(to_parent)
        self.radius.append(float(np.linalg.norm(lifted[rows] - lifted[pivot], axis=1).max(initial=0.0)))
        self.children.append([])
        self.span.append(None)
        if len(rows) <= PAGE:
            self.span[node] = (self._filled, self._filled + len(rows))
            self._filled += len(rows)
            order.append(rows)
            return node
        # As many children as fill their pages about half: small leftovers would cost a visit each.
        fanout = min(FANOUT, max(2, -(-2 * len(rows) // PAGE)))
        pivots = rows[np.linspace(0, len(rows) - 1, fanout).astype(int)]
        away = np.stack([np.linalg.norm(lifted[rows] - lifted[p], axis=1) for p in pivots])
        nearest = away.argmin(0)
        if np.bincount(nearest).max() == len(rows):  # copies of one vector: deal them evenly
            nearest = np.arange(len(rows)) % fanout
        for i, p in enumerate(pivots):
            part = rows[nearest == i]
            if len(part):
                gap = float(np.linalg.norm(lifted[p] - lifted[pivot]))
                self.children[node].append(self._grow(part, lifted, gap, int(p), order))
        return node

    def search(self, query_id: int, q: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(score, id) of the k best, best first."""
        if not len(self.ids):
            return []
        base = float(q @ q) + self.top
        slack = 1e-6 * (1.0 + math.sqrt(base))

        def away(score: float) -> float:
            return math.sqrt(max(base - 2.0 * score, 0.0))
        best: list[tuple[int, int]] = []  # heap of (score, -id)
        reach = math.inf
        root = away(float(self.pivot[0] @ q))
        queue = [(max(root - self.radius[0], 0.0), 0, root)]
        while queue:
            bound, node, d = heapq.heappop(queue)
            if bound > reach + slack:
                break
            kids = self.children[node]
            if len(kids):
                may = kids[np.abs(d - self.to_parent[kids]) - self.radius[kids] <= reach + slack]
                gaps = np.sqrt(np.maximum(base - 2.0 * (self.pivot[may] @ q), 0.0))
                lows = np.maximum(gaps - self.radius[may], 0.0)
                for low, kid, gap in zip(lows.tolist(), may.tolist(), gaps.tolist()):
                    if low <= reach + slack:
                        heapq.heappush(queue, (low, kid, gap))
                continue
            start, end = self.span[node]
            may = start + np.flatnonzero(np.abs(d - self.to_pivot[start:end]) <= reach + slack)
            may = may[self.ids[may] != query_id]
            scores = self.vectors[may] @ q
            if len(best) == k:
                good = scores >= best[0][0]
                may, scores = may[good], scores[good]
            if len(may) > k:
                first = np.lexsort((self.ids[may], -scores))[:k]
                may, scores = may[first], scores[first]
            for s, i in zip(scores.tolist(), self.ids[may].tolist()):
                if len(best) < k:
                    heapq.heappush(best, (int(s), -i))
                else:
                    heapq.heappushpop(best, (int(s), -i))
            if len(best) == k:
                reach = away(best[0][0])
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def quantised(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id, dims and integer components of every usable row, identical rows once."""
    x = F.col(vector)
    usable = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * 256).cast("double"))
    return vectors.filter(F.col(key).isNotNull() & F.coalesce(usable, F.lit(False))).select(
        F.col(key).cast("long").alias("id"), F.size(x).alias("dims"), whole.alias("v")).distinct()


def build_index(rows: DataFrame) -> DataFrame:
    """dims, block, tree: one stored tree per block of vectors."""
    blocks = max(1, -(-rows.count() // BLOCK_ROWS))

    def load(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id", kind="stable")
        dims = int(part["dims"].iloc[0])
        tree = Tree(part["id"].to_numpy(), np.array(part["v"].tolist(), float).reshape(len(part), dims))
        return pd.DataFrame({"dims": [dims], "block": [int(part["block"].iloc[0])], "tree": [pickle.dumps(tree)]})
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int"))
    # A partition per block: the blocks are few bytes but much work, so they are not to be merged by size.
    dealt = dealt.repartition(blocks, "dims", "block")
    return stored(dealt.groupBy("dims", "block").applyInPandas(load, "dims INT, block INT, tree BINARY"), "m-tree")


def search(index: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score of every query's k best. queries: id, dims, v."""
    blocks = max(1, -(-queries.count() // QUERY_ROWS))
    asked = queries.withColumn("q_block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")) \
        .groupBy("dims", "q_block").agg(F.collect_list(F.struct("id", "v")).alias("asked"))
    pairs = index.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))) \
        .join(asked, ["dims", "q_block"]).select("tree", "asked").repartition(min(index.count() * blocks, 100_000) or 1)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for blob, some in zip(part["tree"], part["asked"]):
                tree, found = pickle.loads(blob), []
                for q in some:
                    vector = np.array(q["v"], float)
                    found += [(q["id"], i, s) for s, i in tree.search(q["id"], vector, k)]
                yield pd.DataFrame(found, columns=["query_id", "vec_id", "score"])
    found = pairs.mapInPandas(run, "query_id BIGINT, vec_id BIGINT, score BIGINT")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op8_metric_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: vectors whose id is divisible by 50; candidates: all vectors."""
    rows = stored(quantised(table(spark, sf_dir, "embeddings")), "vectors")
    return search(build_index(rows), rows.filter(F.col("id") % 50 == 0))


SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
