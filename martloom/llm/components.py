"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """id, component (smallest id reachable) of every id that has a link. links: u, v.

    Each round hangs the larger neighbours of every id on its smallest one, then the smaller ones; the links stay as
    many as the ids, a hub's minimum is combined before the shuffle, and rounds grow with the logarithm of the longest chain.
    Null and self links are left out.
    """
    e = stored(links.filter(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            break
        before = now
        both = e.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        # A neighbour goes to the smallest one; the smallest one's own row is that of the id itself.
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = F.when(F.col("v") != F.col("m"), F.col("v")).otherwise(F.col("u"))
        e = stored(large.join(root, "u").select(hung.alias("u"), F.col("m").alias("v")).distinct(), "links")
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
