"""Near-duplicate classes by MinHash with sequential Bayesian verification.

1. Every whole text becomes its set of distinct word shingles, a digest of the set, and one hash per band of its MinHash
   signature. Equal sets meet by digest; the smallest id stands for them.
2. Ids that share a band are hung on the smallest id of that band. Connected components of these unverified links
   are the groups inside which links can exist.
3. The texts of each group meet once. A pair that shares a band is compared signature batch by signature batch and
   dropped as soon as the posterior probability of reaching the similarity falls below `miss`; survivors are
   confirmed on the full sets. A pair already joined through others is not compared again, so copies of copies cost
   one comparison each and no list of all pairs is made. A large group is dealt into blocks of bounded size, and every
   pair of blocks is a task of its own.
4. Components of the confirmed links are the classes.

Words are known by 64 bits of a keyed cryptographic hash, shingles by a mix of five such hashes one after another; two different
shingles share one by chance only, about once in 2^64 pairs. The number of bands follows from the similarity and `miss`, the chance that a pair at the similarity shares no band.

Cases: null, empty and blank texts have an empty set and stand alone; a text shorter than a shingle is one shingle;
a null id is never linked and is kept; rows that share an id are one member; an empty table gives an empty result;
very long texts are read whole; extra columns are ignored, or kept by `keep_first`.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import U64, WORD_BASE, mix, pieces, run_keys, stored, table, text_bytes, word_keys, words
from martloom.llm.components import components

BLOCK_SHINGLES = 1_500_000


@dataclass(frozen=True)
class Plan:
    """Similarity as a fraction, shingle length, rows of a band, chance of a miss, hashes per comparison."""

    share: int = 85
    of: int = 100
    width: int = 5
    rows: int = 5
    miss: float = 1e-6
    batch: int = 20

    @property
    def bands(self) -> int:
        return math.ceil(math.log(self.miss) / math.log(1 - (self.share / self.of) ** self.rows))

    def least_matches(self) -> np.ndarray:
        """For n hashes seen, the fewest matches that leave the posterior of reaching the similarity at `miss` or more.

        Under a uniform prior the posterior after m of n matches is Beta(m + 1, n - m + 1), whose tail above t is
        the probability of at most m successes in n + 1 draws of chance t.
        """
        t, out = self.share / self.of, []
        for n in range(self.bands * self.rows + 1):
            tail, m = 0.0, -1
            while tail < self.miss and m < n:
                m += 1
                tail += math.comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
            out.append(m)
        return np.array(out)


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    data, offsets = text_bytes(texts)
    data = data.copy()
    data[(data >= 65) & (data <= 90)] += 32
    starts, ends, first = words(data, offsets)
    keys = word_keys(data, starts, ends)
    windows = run_keys(keys, np.arange(max(len(starts) - width + 1, 0)), width)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(windows[a: b - width + 1]))
        elif b > a:
            out.append(run_keys(keys, np.array([a]), b - a))
        else:
            out.append(np.zeros(0, U64))
    return out


def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    draw = mix(np.arange(1, 2 * n + 1, dtype=U64) * U64(WORD_BASE))
    return draw[:n] | U64(1), draw[n:]


def signature(shingles: np.ndarray, n: int) -> np.ndarray:
    """n minima of random linear hashes of a set that is not empty."""
    a, b = _functions(n)
    out = np.full(n, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(shingles), 2048):
        values = (shingles[at: at + 2048, None] * a + b) >> U64(32)
        out = np.minimum(out, values.min(0).astype(np.uint32))
    return out


def band_hashes(signatures: np.ndarray, plan: Plan) -> np.ndarray:
    parts = signatures.reshape(-1, plan.bands, plan.rows).astype(U64)
    out = np.arange(plan.bands, dtype=U64)[None, :] + U64(1)
    for i in range(plan.rows):
        out = mix(out * U64(WORD_BASE) + parts[:, :, i])
    return out.view(np.int64)


def sketches(docs: DataFrame, plan: Plan, key: str, text: str) -> DataFrame:
    """id, n_shingles, digest (null for the empty set), bands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text", 1 << 20):
            sets = shingle_sets(part.column("text"), plan.width)
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            bands = [list(band_hashes(signature(s, plan.bands * plan.rows), plan)[0]) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))], ["id", "n_shingles", "digest", "bands"])
    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(
        run, "id BIGINT, n_shingles BIGINT, digest BINARY, bands ARRAY<BIGINT>")


def linked(ids: np.ndarray, sets: list[np.ndarray], plan: Plan, least: np.ndarray) -> list[tuple[int, int]]:
    """Confirmed links that connect every class of one group; pairs already connected are not compared."""
    n = len(ids)
    sizes = np.array([len(s) for s in sets])
    hashes = np.stack([signature(s, plan.bands * plan.rows) for s in sets])
    bands, where, out = band_hashes(hashes, plan), np.arange(n), []

    def confirm(x: int, others: np.ndarray) -> None:
        small, large = np.minimum(sizes[others], sizes[x]), np.maximum(sizes[others], sizes[x])
        others = others[plan.of * small >= plan.share * large]
        others = others[(bands[others] == bands[x]).any(1)]
        matches = np.zeros(len(others), int)
        for at in range(0, hashes.shape[1], plan.batch):
            end = min(at + plan.batch, hashes.shape[1])
            matches += (hashes[others, at:end] == hashes[x, at:end]).sum(1)
            stay = matches >= least[end]
            others, matches = others[stay], matches[stay]
        for y in others.tolist():
            if where[y] == where[x]:
                continue
            at = np.minimum(np.searchsorted(sets[x], sets[y]), sizes[x] - 1)
            common = int((sets[x][at] == sets[y]).sum())
            if plan.of * common >= plan.share * (sizes[x] + sizes[y] - common):
                out.append((int(ids[x]), int(ids[y])))
                where[where == where[y]] = where[x]
    leads = np.zeros(n, bool)
    for x in range(n):
        if (where[:x] == where[x]).any():  # joined to an earlier one
            continue
        leads[x] = True
        confirm(x, np.flatnonzero(where != where[x]))
    for x in np.flatnonzero(~leads):
        rest = np.flatnonzero((where != where[x]) & ~leads)
        if len(rest):
            confirm(x, rest)
    return out


def confirmed_links(docs: DataFrame, groups: DataFrame, plan: Plan, key: str, text: str) -> DataFrame:
    """u, v: links of full sets. groups: id, n_shingles, component."""
    weight = groups.groupBy("component").agg(F.sum("n_shingles").alias("weight"))
    blocks = F.ceil(F.col("weight") / BLOCK_SHINGLES).cast("int")
    packs = max(12, -(-(groups.agg(F.sum("n_shingles")).first()[0] or 0) // BLOCK_SHINGLES))
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    placed = groups.join(weight.withColumn("blocks", blocks), "component").withColumn("block", block)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = placed.withColumn("other", other).select(
        "id", "component",
        F.when(F.col("blocks") == 1, F.concat(F.lit("pack "), F.pmod(F.xxhash64("component"), F.lit(packs))))
        .otherwise(F.concat_ws(" ", "component", F.least("block", "other"), F.greatest("block", "other"))).alias("task"))
    placed = stored(placed, "near-groups")
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).join(placed, "id")
    least = plan.least_matches()

    def verify(part: pd.DataFrame) -> pd.DataFrame:
        part = part.drop_duplicates(["id", "text"]).sort_values(["component", "id"], kind="stable")
        found = []
        for _, group in part.groupby("component", sort=False):
            sets = shingle_sets(pa.array(group["text"], pa.string()), plan.width)
            full = [i for i, s in enumerate(sets) if len(s)]
            if len(full) > 1:
                found += linked(group["id"].to_numpy()[full], [sets[i] for i in full], plan, least)
        return pd.DataFrame(found, columns=["u", "v"], dtype="int64")
    return texts.groupBy("task").applyInPandas(verify, "u BIGINT, v BIGINT")


def classes(docs: DataFrame, plan: Plan | None = None, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_shingles, component_id of every row."""
    plan = plan or Plan()
    rows = stored(sketches(docs, plan, key, text), "sketches")
    sets = stored(rows.filter(F.col("digest").isNotNull() & F.col("id").isNotNull()).groupBy("digest").agg(
        F.min("id").alias("first"), F.max("n_shingles").alias("n_shingles"), F.min_by("bands", "id").alias("bands")),
        "sets")
    banded = sets.select("first", F.explode("bands").alias("band"))
    heads = banded.groupBy("band").agg(F.min("first").alias("head"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    maybe = banded.join(heads, "band").select(F.col("first").alias("u"), F.col("head").alias("v"))
    groups = components(maybe).join(sets.groupBy("first").agg(F.sum("n_shingles").alias("n_shingles")).withColumnRenamed(
        "first", "id"), "id")
    links = stored(confirmed_links(docs, groups, plan, key, text), "confirmed")
    joined = components(links)
    of_set = sets.select("digest", "first").join(joined.withColumnRenamed("id", "first"), "first", "left").select(
        "digest", F.coalesce("component", "first").alias("component"))
    return rows.select("id", "n_shingles", "digest").join(of_set, "digest", "left").select(
        "id", "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"))


def keep_first(docs: DataFrame, plan: Plan, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of every class: that of the smallest id. Of rows that share an id, all stay or all go."""
    gone = classes(docs, plan, key=key, text=text).filter(F.col("component_id") != F.col("id")).select("id").distinct()
    gone = stored(gone, "near-copies")
    return docs.join(gone, F.col(f"`{key}`").cast("long") == gone["id"], "left_anti")


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, linked from 85 common shingles in 100."""
    found = classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id",
                        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
