"""Benchmark decontamination by template canonicalisation.

Text becomes a template: capitalised words, numbers, and units beside numbers turn into typed placeholders, other words into
lower case; names side by side are one placeholder, a number with its unit another. Words are runs of letters, marks, digits and
placeholders, so punctuation parts words as blanks do. Windows of `width` template words of all documents meet the windows of the
benchmark in one hash join. Under `whole` windows of plain words (lower case, no placeholders) meet in the same join, so a
copy in another case or with other blanks is found though its names are not.

Hits are gathered by how an item lies over a text: at one offset, and over neighbouring offsets (stretches of twice the
item's length that overlap by half), so that words left out or added shift nothing out of reach. The values that fill
the placeholders, without their punctuation, must agree: one benchmark value stands for one document value, so a
question with other numbers or names is caught and an accidental fit is not. A window that disagrees does not count; the others
do. An item is found when `run` of its windows match and agree (all but one, in shorter items). Two benchmark values may
become one; two names only under `whole`.

Template windows with fewer than `literals` distinct plain words say too little and are not used; windows of plain words are
all used, so under `whole` every item that has a word is looked for, whatever it is made of. Items shorter than a window are
one window of their own length. Everything is DataFrame functions. The joined benchmark windows are a stored table of known
size: Spark broadcasts them if they are small and shuffles both sides if not.

Cases: null and empty texts are clean, null and empty items match nothing; equal texts are judged once and alike, so
repeated rows and repeated or null ids do no harm; very long texts are read whole; repeated items are found under
the smallest id; an empty benchmark leaves all documents clean; an empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import free_names, stored, table

# Placeholders are private-use characters, so no text holds them by chance.
NAME, NUMBER, UNIT, JOIN, POINT = "\ue000", "\ue001", "\ue002", "\ue003", "\ue004"
UNITS = (
    "percent|dollars|dollar|euros|euro|cents|cent|pounds|pound|kilometers|kilometres|km|meters|metres|cm|mm|miles|mile"
    "|feet|foot|inches|inch|kilograms|kg|grams|mg|liters|litres|ml|hours|hour|minutes|minute|seconds|second|days|day"
    "|weeks|week|months|month|years|year|degrees|degree|mph|kmh|m|g|l|h|s"
)
BLANK = r" \t\n\x0B\f\r"
BETWEEN = rf"[^\p{{L}}\p{{M}}\p{{N}}{NAME}{NUMBER}{UNIT}{JOIN}{POINT}]+"


@dataclass(frozen=True)
class Rule:
    width: int = 8
    literals: int = 4
    run: int = 6
    whole: bool = False  # True also reports what test_leaks_by_template wants kept; op2 and the pipeline ask for it


def template(text: Column) -> Column:
    """Typed words. A capitalised word is a name wherever it stands, so what is before it does not matter.

    Names side by side are one placeholder, and so is a number with its unit. Groups repeat possessively: otherwise a long run
    would fill the stack.
    """
    out = F.regexp_replace(text, rf"\p{{Lu}}\p{{Ll}}+(?:[{BLANK}]+\p{{Lu}}\p{{Ll}}+)*+", NAME)
    out = F.regexp_replace(F.lower(out), r"[0-9]+(?:[.,][0-9]+)*+", NUMBER)
    unit = rf"[{BLANK}]*(?:{UNITS})(?!\p{{L}})"
    return F.regexp_replace(out, rf"{NUMBER}{unit}|[$€£][{BLANK}]*{NUMBER}(?:{unit})?", UNIT)


def valued(text: Column) -> Column:
    """Lower-cased words at the places of the template's words: what fills a placeholder there."""
    out = F.regexp_replace(text, rf"(\p{{Lu}}\p{{Ll}}+)[{BLANK}]+(?=\p{{Lu}}\p{{Ll}})", f"$1{JOIN}")
    out = F.regexp_replace(F.lower(out), "([0-9])[.,](?=[0-9])", f"$1{POINT}")
    out = F.regexp_replace(out, rf"([0-9])[{BLANK}]*({UNITS})(?!\p{{L}})", f"$1{JOIN}$2")
    return F.regexp_replace(out, rf"[$€£][{BLANK}]*(?=[0-9])", JOIN)


def split_words(text: Column) -> Column:
    """Words at their places; what parts words makes none at the ends."""
    return F.array_remove(F.split(text, BETWEEN), "")


def hashed(frame: DataFrame, keep: list[str], widths: dict[str, set[int]]) -> DataFrame:
    """keep, n_<kind> (words) and h_<kind>_<width>, the hashes of all windows, none in shorter texts.

    kind: t (template words) or p (plain words). A word is hashed once; a longer window is the hash of its two parts.
    """
    parts: dict[str, dict[int, int]] = {}
    for kind, asked in widths.items():
        need, open_ = {}, set(asked)
        while open_:
            w = open_.pop()
            need[w] = 1 << ((w - 1).bit_length() - 1) if w > 1 else 0  # words of the first part
            open_ |= {need[w], w - need[w]} - set(need) if w > 1 else set()
        parts[kind] = need | {1: 0}

    def single(k: str) -> Column:
        return F.transform(k, lambda word: F.xxhash64(F.lit(k), word)).alias(f"h_{k}_1")
    out = frame.select(*keep, *[F.size(k).alias(f"n_{k}") for k in parts], *[single(k) for k in parts])

    for w in sorted({w for need in parts.values() for w in need} - {1}):
        def joined(k: str) -> Column:
            first, n = parts[k][w], F.greatest(F.col(f"n_{k}") - (w - 1), F.lit(0))
            return F.zip_with(F.slice(f"h_{k}_{first}", 1, n), F.slice(f"h_{k}_{w - first}", first + 1, n),
                              lambda a, b: F.xxhash64(a, b)).alias(f"h_{k}_{w}")
        out = out.select("*", *[joined(k) for k in parts if w in parts[k]])
    return out


def filled(text: Column) -> Column:
    return text.rlike(f"[{NAME}{NUMBER}{UNIT}]")


def read_items(benchmark: DataFrame, key: str, text: str) -> DataFrame:
    """item (a hash of the text), item_id (smallest), t (template words), o (what fills them), p (plain words)."""
    told = benchmark.filter(F.col(text).isNotNull()).groupBy(F.col(text).alias("_text")).agg(F.min(key).alias("item_id"))
    told = told.select(F.xxhash64("_text").alias("item"), "item_id", split_words(template(F.col("_text"))).alias("t"),
                       split_words(valued(F.col("_text"))).alias("o"), split_words(F.lower("_text")).alias("p"))
    return told.filter(F.size("p") > 0)


def item_windows(items: DataFrame, rule: Rule) -> DataFrame:
    """item, kind, width, place, h, reach (words of the item), total of all windows that say enough.

    Plain windows that are equal count once.
    """
    told = None
    for kind in ("t", "p") if rule.whole else ("t",):
        sized = items.withColumn("width", F.least(F.size(kind), F.lit(rule.width)))
        sizes = sorted(r[0] for r in sized.select("width").distinct().collect())  # at most `width` numbers
        words = F.slice("words", F.col("place") + 1, F.col("width"))
        enough = F.size(F.array_distinct(F.filter(words, lambda w: ~filled(w)))) >= rule.literals if kind == "t" else F.lit(True)
        for size in sizes or [rule.width]:
            some = hashed(sized.filter(F.col("width") == size).withColumn("words", F.col(kind)), ["item", "width", "words"],
                          {kind: {size}}).select("item", F.lit(kind).alias("kind"), "width", "words", F.posexplode(
                              f"h_{kind}_{size}").alias("place", "h")).filter(enough).drop("words")
            told = some if told is None else told.unionByName(some)
    place = F.when(F.col("kind") == "t", F.col("place"))
    told = told.groupBy("item", "kind", "width", "h", place.alias("_own")).agg(F.min("place").alias("place")).drop("_own")
    told = told.join(items.select("item", *[F.size(k).alias(f"n_{k}") for k in ("t", "p")]), "item").withColumn(
        "reach", F.when(F.col("kind") == "t", F.col("n_t")).otherwise(F.col("n_p"))).drop("n_t", "n_p")
    return told.join(told.groupBy("item", "kind").agg(F.count_distinct("place").alias("total")), ["item", "kind"])


def found_windows(docs: DataFrame, asked: DataFrame, rule: Rule, text: str) -> DataFrame:
    """text_key, place and the columns of asked, of every window of a text that is one of asked.

    The hashes of all kinds and widths are made before the explode: an array of words kept beside each exploded row would be
    copied once a window.
    """
    specs = sorted((r[0], r[1]) for r in asked.select("kind", "width").distinct().collect())  # at most 2 * `width`
    specs = specs or [("t", rule.width)]
    kinds = sorted({k for k, _ in specs})
    told = docs.filter(F.col(text).isNotNull()).select(F.xxhash64(F.col(text)).alias("text_key"), *[
        split_words(F.lower(F.col(text)) if k == "p" else template(F.col(text))).alias(k) for k in kinds])
    told = hashed(told, ["text_key"], {kind: {w for k, w in specs if k == kind} for kind in kinds})
    told = told.select("text_key", *[f"n_{k}" for k in kinds],
                       F.posexplode(F.concat(*[F.col(f"h_{k}_{w}") for k, w in specs])).alias("pos", "h"))
    start, sofar = F.lit(None).cast("int"), F.lit(0)
    for k, w in specs:
        start = F.when((F.col("kind") == k) & (F.col("width") == w), sofar).otherwise(start)
        sofar = sofar + F.greatest(F.col(f"n_{k}") - w + 1, F.lit(0))
    return told.join(asked.withColumnRenamed("place", "item_place"), "h").withColumn("place", F.col("pos") - start)


def hits(docs: DataFrame, benchmark: DataFrame, rule: Rule, *, key: str = "item_id", item_text: str = "text",
         text: str = "text") -> DataFrame:
    """text_key, items, item_id (smallest), n_windows (of the best placement) of every text that holds an item."""
    items = stored(read_items(benchmark, key, item_text), "items")
    asked = stored(item_windows(items, rule), "item-windows")
    found = found_windows(docs, asked, rule, text)
    offset = F.col("place") - F.col("item_place")
    groups = F.array(*[F.struct(F.lit(level).alias("level"), at.cast("long").alias("offset")) for level, at in enumerate(
        (offset, F.floor(offset / (2 * F.col("reach"))), F.floor((offset + F.col("reach")) / (2 * F.col("reach")))))])
    placed = found.withColumn("at", F.explode(groups)).withColumn("g", F.struct("text_key", "item", "at.*")).groupBy(
        "g", "kind", "width", "total").agg(F.collect_set(F.struct("item_place", "place")).alias("seen"))
    n_windows = F.size(F.array_distinct("seen.item_place"))
    placed = stored(placed.withColumn("need", F.least(F.lit(rule.run), F.greatest(F.col("total") - 1, F.lit(1)))).filter(
        n_windows >= F.col("need")), "placements")
    fitting = consistent(docs, items, placed.filter("kind = 't'"), rule, text).unionByName(
        placed.filter("kind = 'p'").select("g.text_key", "g.item", n_windows.cast("long").alias("n_windows")))
    return fitting.join(items.select("item", "item_id"), "item").groupBy("text_key").agg(
        F.count_distinct("item").alias("items"), F.min("item_id").alias("item_id"),
        F.max("n_windows").alias("n_windows"))


def consistent(docs: DataFrame, items: DataFrame, placed: DataFrame, rule: Rule, text: str) -> DataFrame:
    """text_key, item, n_windows of the placements with enough windows whose placeholder values agree.

    A benchmark value stands for the document value that fills it in most windows (in a tie, the first); windows that say
    otherwise do not count, the others do.
    """
    keys = ["g", "item_place", "place"]
    # Stored by itself: eight bytes a text, so texts are filtered where they are and not shuffled whole.
    wanted = stored(placed.select(F.col("g.text_key").alias("text_key")).distinct(), "placed-texts")
    texts = docs.select(F.xxhash64(F.col(text)).alias("text_key"), F.col(text).alias("_text")) \
        .join(wanted, "text_key", "left_semi") \
        .dropDuplicates(["text_key"]).select("text_key", split_words(valued(F.col("_text"))).alias("said"))
    slots = F.transform("seen", lambda s: F.struct(s.item_place.alias("item_place"), s.place.alias("place"), F.transform(
        F.filter(F.sequence(F.lit(0), F.col("width") - 1), lambda i: filled(F.get("t", s.item_place + i))),
        lambda i: F.struct(F.concat(F.get("t", s.item_place + i), F.get("o", s.item_place + i)).alias("theirs"),
                           F.get("said", s.place + i).alias("ours"))).alias("pairs")))
    told = placed.select("*", "g.text_key", "g.item").join(items.select("item", "t", "o"), "item").join(texts, "text_key")
    told = told.select("g", "need", F.explode(slots).alias("s")).select("g", "need", "s.*")
    told = stored(told.select("g", "need", "item_place", "place", F.explode_outer("pairs").alias("p")).select(
        "g", "need", "item_place", "place", "p.*"), "slots")
    votes = told.filter(F.col("theirs").isNotNull()).groupBy("g", "theirs", "ours").agg(
        F.count_distinct("place").alias("n"), F.min("place").alias("first"))
    chosen = votes.groupBy("g", "theirs").agg(F.max_by("ours", F.struct("n", -F.col("first"))).alias("chosen"))
    agree = F.coalesce(F.col("ours") == F.col("chosen"), F.col("theirs").isNull())
    good = told.join(chosen, ["g", "theirs"], "left").groupBy(*keys).agg(
        F.first("need").alias("need"), F.bool_and(agree).alias("good")).filter("good")
    if not rule.whole:  # two names that become one
        merged = chosen.filter(F.col("theirs").contains(NAME)).groupBy("g", "chosen").agg(F.count("*").alias("n")).filter("n > 1")
        good = good.join(merged.select("g").distinct(), "g", "left_anti")
    return good.groupBy("g").agg(F.first("need").alias("need"), F.count_distinct("item_place").alias("n_windows")) \
        .filter(F.col("n_windows") >= F.col("need")).select("g.text_key", "g.item", "n_windows")


def clean(docs: DataFrame, benchmark: DataFrame, rule: Rule | None = None, *, text: str = "text") -> DataFrame:
    """The rows of docs, with their columns, that hold no item."""
    mark = free_names(docs.columns, 1)[0]
    found = stored(hits(docs, benchmark, rule or Rule(), text=text).select(F.col("text_key").alias(mark)), "leaks")
    return docs.join(found, F.xxhash64(F.col(f"`{text}`")) == F.col(mark), "left_anti")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against the whole benchmark."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = stored(hits(docs, table(spark, sf_dir, "benchmark"), Rule(whole=True)), "leaks")
    return docs.select("doc_id", F.xxhash64("text").alias("text_key")).join(found, "text_key", "left").select(
        "doc_id", F.col("items").isNotNull().alias("contaminated"), F.coalesce("items", F.lit(0)).alias("n_items"), "item_id",
        F.coalesce("n_windows", F.lit(0)).alias("n_windows"))
