"""Mixing sources to target weights by hierarchical budgets.

Sources form a tree (domain, language, source by default). The token budget flows down it: the children of a node share its
allotment by weight, no child gets more than its subtree can give in `epochs` passes, and what a full child leaves goes to
its brothers and sisters. Only when a whole family is full does the rest go back to the brothers and sisters of the
parent, because the parent's own cap is the sum of its children's. Leaves at or below a node of weight 0 have a cap of 0.

A leaf takes its allotment as whole passes plus a prefix of one more: documents in the order of a hash of seed, pass and id,
as long as their running total stays within the rest. Running totals are sums per hash bucket first and exact only
inside the one bucket where the prefix ends, so a leaf that holds a third of all rows is never sorted in one task. The cut is
a single hash per leaf; documents are compared with it where they are and are not shuffled.

Everything is DataFrame functions. Tokens are words here: runs other than 0x20 and 0x09-0x0D.

Cases: null levels are nodes of their own, apart from empty text; a null or empty text has 0 tokens and follows the cut like
any other; a leaf without tokens gets no copies; weights not given are 1, weight 0 takes nothing; rows that share
an id go together; ties in shares go by name; an empty table gives an empty result; other columns are kept as they are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.llm.common import free_names, stored, table

WORD = r"[^\x20\x09-\x0D]+"
BUCKET = 3  # hex digits of the hash


def domain(source: Column) -> Column:
    """Four domains by a digest of the source, since the tables name none."""
    first = F.substring(F.md5(F.coalesce(source, F.lit("")).cast("binary")), 1, 1)
    return F.when(first < "4", "a").when(first < "8", "b").when(first < "c", "c").otherwise("d")


@dataclass(frozen=True)
class Recipe:
    """Share of all tokens to select, passes at most, seed, and weights by level and name."""

    share: tuple[int, int] = (1, 2)
    epochs: int = 2
    seed: int = 7
    weights: dict[str, dict[str, int]] = field(default_factory=lambda: {
        "domain": {"a": 3, "b": 2}, "lang": {"en": 4, "de": 2, "fr": 2}})


def levels_of(docs: DataFrame) -> dict[str, Column]:
    return {"domain": domain(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}


def _named(value: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), value), F.lit("null"))


def _weight(level: str, recipe: Recipe) -> Column:
    out = F.lit(1)
    for name, weight in recipe.weights.get(level, {}).items():
        out = F.when(F.col(f"_{level}") == f"={name}", weight).otherwise(out)
    return out.cast("decimal(10,0)")


def _hash(recipe: Recipe, done: Column, key: Column) -> Column:
    text = F.concat_ws(":", F.lit(str(recipe.seed)), (done + 1).cast("string"),
                       F.coalesce(key.cast("string"), F.lit("null")))
    return F.md5(text.cast("binary"))


def tokens(docs: DataFrame, levels: dict[str, Column], key: str, text: str) -> DataFrame:
    """key, path and tokens of every row."""
    count = F.when(F.col(text).isNull(), 0).otherwise(F.regexp_count(F.col(text), F.lit(WORD)))
    return docs.select(F.col(key).alias("_key"), *[_named(c).alias(f"_{n}") for n, c in levels.items()],
                       count.cast("long").alias("n_tokens"))


def shared_out(nodes: DataFrame, family: list[str], recipe: Recipe, level: str) -> DataFrame:
    """Allotment of every node from its parent's `budget`. nodes: path, cap, budget (decimals)."""
    weighted = nodes.withColumn("w", _weight(level, recipe))
    ratio = F.when(F.col("w") > 0, F.col("cap").cast("double") / F.col("w").cast("double")).otherwise(float("inf"))
    by = Window.partitionBy(*family).orderBy(ratio, f"_{level}")
    before = F.coalesce(F.sum("cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("w").over(by.rowsBetween(0, Window.unboundedFollowing))
    whole = Window.partitionBy(*family)
    marked = weighted.withColumn("full", (F.col("w") > 0) & (
        F.col("cap") * after.cast("decimal(14,0)") <= (F.col("budget") - before).cast("decimal(22,0)") * F.col("w")))
    split = marked.withColumns({
        "rest": F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(whole), F.lit(0)),
        "open": F.sum(F.when(~F.col("full"), F.col("w"))).over(whole).cast("decimal(14,0)")})
    part = F.when(F.col("full"), F.col("cap")).when(
        F.col("open") > 0, F.least(F.col("cap"), F.expr("(cast(rest AS DECIMAL(22,0)) * w) div open").cast("decimal(22,0)"))
    ).otherwise(F.lit(0))
    return split.withColumn("allot", part.cast("decimal(22,0)")).drop("w", "full", "rest", "open")


def budgets(rows: DataFrame, names: list[str], recipe: Recipe) -> DataFrame:
    """path, n_tokens (one pass), allot of every leaf."""
    path = [f"_{n}" for n in names]
    leaves = rows.groupBy(*path).agg(F.sum("n_tokens").alias("n_tokens"))
    taking = F.lit(True)
    for name in names:
        taking = taking & (_weight(name, recipe) > 0)
    cap = F.when(taking, F.col("n_tokens") * recipe.epochs).otherwise(0)
    leaves = stored(leaves.withColumn("cap", cap.cast("decimal(22,0)")), "leaves")
    up, down = recipe.share
    given = leaves.agg(F.expr(f"(sum(n_tokens) * {up}) div {down}").cast("decimal(22,0)").alias("budget"),
                       F.sum("cap").cast("decimal(22,0)").alias("top")).first()
    budget = min(given["budget"] or 0, given["top"] or 0)
    parents = None
    for i, name in enumerate(names):
        nodes = leaves.groupBy(*path[: i + 1]).agg(F.sum("cap").cast("decimal(22,0)").alias("cap"))
        nodes = nodes.withColumn("budget", F.lit(budget).cast("decimal(22,0)")) if parents is None else \
            nodes.join(parents, path[:i])
        parents = shared_out(nodes, path[:i], recipe, name).select(
            *path[: i + 1], F.col("allot").alias("budget"))
    return parents.withColumnRenamed("budget", "allot").join(leaves.select(*path, "n_tokens"), path)


def cuts(rows: DataFrame, leaves: DataFrame, names: list[str], recipe: Recipe) -> DataFrame:
    """path, passes, cut: whole passes of every leaf and the last hash of its prefix (null: no prefix)."""
    path = [f"_{n}" for n in names]
    done = F.when(F.col("n_tokens") > 0, F.expr("allot div n_tokens")).otherwise(0)
    plan = leaves.withColumn("passes", done.cast("long")).withColumn(
        "rest", (F.col("allot") - F.col("passes") * F.col("n_tokens")).cast("long")).select(*path, "passes", "rest")
    plan = stored(plan, "passes")
    hashed = rows.join(plan, path).filter(F.col("rest") > 0).withColumn("h", _hash(recipe, F.col("passes"), F.col("_key")))
    hashed = hashed.withColumn("bucket", F.substring("h", 1, BUCKET))
    along = Window.partitionBy(*path).orderBy("bucket")
    sums = hashed.groupBy(*path, "rest", "bucket").agg(F.sum("n_tokens").alias("n"))
    ends = sums.withColumn("upto", F.sum("n").over(along)).filter(F.col("upto") > F.col("rest"))
    first = ends.groupBy(*path).agg(F.min("bucket").alias("bucket"), F.min_by(
        F.col("upto") - F.col("n"), "bucket").alias("before"))
    first = stored(first, "prefix-ends")
    inside = hashed.join(first, [*path, "bucket"]).withColumn(
        "upto", F.col("before") + F.sum("n_tokens").over(Window.partitionBy(*path).orderBy("h")))
    last = inside.groupBy(*path).agg(F.max(F.when(F.col("upto") <= F.col("rest"), F.col("h"))).alias("last"))
    cut = first.join(last, path, "left").select(*path, F.coalesce("last", "bucket").alias("cut"))
    return stored(plan.join(cut, path, "left").select(*path, "passes", "cut"), "cuts")


def copies(cut: Column, passes: Column, h: Column) -> Column:
    return (passes + F.when(h <= cut, 1).otherwise(0)).cast("int")


def mixed(docs: DataFrame, recipe: Recipe, *, levels: dict[str, Column] | None = None, key: str = "doc_id",
          text: str = "text", into: str = "copies") -> DataFrame:
    """The selected rows of docs, all columns, and how often each is to be used."""
    levels = levels or levels_of(docs)
    names, taken = list(levels), [c for c in docs.columns if c.lower() != into.lower()]
    rows = stored(tokens(docs, levels, key, text), "tokens")
    cut = cuts(rows, budgets(rows, names, recipe), names, recipe)
    path = free_names([*docs.columns, into], len(names) + 2)
    last, passes = path[len(names):]
    cut = cut.select(*[F.col(f"_{n}").alias(p) for n, p in zip(names, path)], F.col("cut").alias(last), F.col("passes").alias(passes))
    path = path[: len(names)]
    placed = docs.select(*[F.col(f"`{c}`") for c in taken], *[_named(c).alias(p) for p, c in zip(path, levels.values())])
    many = copies(F.col(last), F.col(passes), _hash(recipe, F.col(passes), F.col(f"`{key}`")))
    return placed.join(cut, path).select(*[F.col(f"`{c}`") for c in taken], many.alias(into)).filter(F.col(into) > 0)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: half of all tokens, by the weights of the default recipe; documents that are selected."""
    recipe, docs = Recipe(), table(spark, sf_dir, "documents")
    levels = levels_of(docs)
    names, path = list(levels), [f"_{n}" for n in levels]
    rows = stored(tokens(docs, levels, "doc_id", "text"), "tokens")
    chosen = rows.join(cuts(rows, budgets(rows, names, recipe), names, recipe), path)
    chosen = chosen.withColumn("copies", copies(
        F.col("cut"), F.col("passes"), _hash(recipe, F.col("passes"), F.col("_key"))))
    return chosen.filter(F.col("copies") > 0).select(F.col("_key").alias("doc_id"), "n_tokens", "copies")


def _level_sql(level: str, family: str, parent: str, weights: str, into: str, path: str) -> str:
    """One step down the tree: children of each family take their caps in order of fullness, the rest split by weight."""
    part = f"PARTITION BY {family}" if family else ""
    keep = f"{family}, {level}" if family else level
    source = f"(SELECT {keep}, sum(cap) AS cap FROM leaves GROUP BY {keep})"
    join = f"{source} JOIN {parent} USING ({family})" if family else f"{source}, {parent}"
    return f"""
{into}_w AS (SELECT *, CAST({weights} AS HUGEINT) AS w FROM {join}),
{into}_f AS (
  SELECT *, cap * sum(w) OVER later <= (budget - coalesce(sum(cap) OVER sooner, 0)) * w AS is_full FROM {into}_w
  WINDOW later AS ({part} ORDER BY cap / w, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
         sooner AS ({part} ORDER BY cap / w, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
{into} AS (
  SELECT {keep}, CASE WHEN is_full THEN cap ELSE least(cap, CAST(
      (budget - coalesce(sum(cap) FILTER (is_full) OVER ({part}), 0)) AS HUGEINT) * w
      // CAST(sum(w) FILTER (NOT is_full) OVER ({part}) AS HUGEINT)) END AS budget
  FROM {into}_f)"""


SQL = f"""
WITH rows_ AS (
  SELECT doc_id, coalesce('=' || lang, 'null') AS lg, coalesce('=' || source, 'null') AS src,
    CASE WHEN left(md5(coalesce(source, '')), 1) < '4' THEN 'a' WHEN left(md5(coalesce(source, '')), 1) < '8' THEN 'b'
         WHEN left(md5(coalesce(source, '')), 1) < 'c' THEN 'c' ELSE 'd' END AS dom,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS n_tokens
  FROM documents),
leaves AS (SELECT dom, lg, src, sum(n_tokens) AS n_tokens, CAST(2 * sum(n_tokens) AS HUGEINT) AS cap FROM rows_ GROUP BY ALL),
whole AS (SELECT CAST(sum(n_tokens) // 2 AS HUGEINT) AS budget FROM leaves),
{_level_sql("dom", "", "whole", "CASE dom WHEN 'a' THEN 3 WHEN 'b' THEN 2 ELSE 1 END", "doms", "dom")},
{_level_sql("lg", "dom", "doms", "CASE lg WHEN '=en' THEN 4 WHEN '=de' THEN 2 WHEN '=fr' THEN 2 ELSE 1 END", "langs", "")},
{_level_sql("src", "dom, lg", "langs", "1", "srcs", "")},
plan AS (
  SELECT dom, lg, src, CASE WHEN n_tokens > 0 THEN CAST(budget // CAST(n_tokens AS HUGEINT) AS BIGINT) ELSE 0 END AS passes,
    budget, n_tokens AS pass_tokens
  FROM srcs JOIN leaves USING (dom, lg, src)),
hashed AS (
  SELECT *, md5(concat_ws(':', '7', CAST(passes + 1 AS VARCHAR), coalesce(CAST(doc_id AS VARCHAR), 'null'))) AS h
  FROM rows_ JOIN plan USING (dom, lg, src)),
run AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY dom, lg, src ORDER BY h) AS upto FROM hashed)
SELECT doc_id, CAST(n_tokens AS BIGINT) AS n_tokens,
  CAST(passes + CASE WHEN budget - passes * pass_tokens > 0 AND upto <= budget - passes * pass_tokens
    THEN 1 ELSE 0 END AS INTEGER) AS copies
FROM run
WHERE passes > 0 OR (budget - passes * pass_tokens > 0 AND upto <= budget - passes * pass_tokens)
"""
