"""Chat formatting of reply trees.

Messages with a parent form trees. Iterated self-joins double the distance of every message's pointer until all point at
nothing, which gives depths and score sums along the way in log2(depth) rounds; the same pointers then enumerate the
messages of every chosen root-to-leaf path. Branches of a tree rank by mean message score (ties: smaller leaf), the best
`branches` are kept, and each becomes one conversation text with a mask of the parts to learn from.

Template: `[INST] user [/INST]`, `<<SYS>> system <</SYS>>`, ` assistant</s>`, and for any other role
`[ROLE] role [/ROLE] text [/TURN]`, after one `<s>`. A control string inside a text or role gets a backslash after its
first character (one more if it has some already), and `read_back` takes one away, so every text comes back as it was.

Cases: null texts and roles are empty; a null score counts as 0; a message whose parent is missing is a root; messages
on a ring of parents hang on no root and are on no path; rows with the same message id must not occur (the query numbers
its rows, so repeated rows and tied turns are separate turns); a null tree is a tree of its own; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.llm.common import stored, table

# The control strings of the template.
CONTROL = r"/?INST\]|/?ROLE\]|/TURN\]|<SYS>>|</SYS>>|/?s>"
ESCAPE = rf"([\[<])(\\*)(?={CONTROL})"
TURN = re.compile(
    r"\[INST\] (?P<user>.*?) \[/INST\]|<<SYS>> (?P<system>.*?) <</SYS>>"
    r"|\[ROLE\] (?P<role>.*?) \[/ROLE\] (?P<other>.*?) \[/TURN\]| (?P<assistant>.*?)</s>", re.DOTALL)
UNESCAPE = re.compile(rf"([\[<])\\(\\*)(?={CONTROL})")


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1$2\\")


def unescaped(text: str) -> str:
    return UNESCAPE.sub(r"\1\2", text)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Role and text of every turn of a formatted conversation."""
    turns, at = [], len("<s>")
    while at < len(formatted):
        m = TURN.match(formatted, at)
        kind = m.lastgroup
        if kind == "other":
            turns.append((unescaped(m["role"]), unescaped(m["other"])))
        else:
            turns.append((kind, unescaped(m[kind])))
        at = m.end()
    return turns


def pointers(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Ancestor tables at distances 1, 2, 4, ... and the finished walk of each rooted message.

    messages: id, parent (id or null), value. Returns [(id, up)], and (id, depth, total) summed from the root.
    Each round is one self-join on the message id; a ring never finishes and is left out when no pointer ends any more.
    """
    known = messages.select(F.col("id").alias("up"), F.lit(True).alias("known"))
    walk = messages.select("id", F.col("parent").alias("up"), F.col("value").alias("total")).join(known, "up", "left") \
        .select("id", F.when(F.col("known"), F.col("up")).alias("up"), F.lit(1).cast("long").alias("depth"), "total")
    walk, jumps, before, done = stored(walk, "walk"), [], None, []
    while True:
        done.append(walk.filter(F.col("up").isNull()))
        left = walk.filter(F.col("up").isNotNull())
        n = left.count()
        if n == 0 or n == before:
            break
        jumps.append(left.select("id", "up"))
        above = reduce(DataFrame.unionByName, done, left).select(
            F.col("id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("d"), F.col("total").alias("t"))
        walk = stored(left.join(above, "up").select(
            "id", F.col("next").alias("up"), (F.col("depth") + F.col("d")).alias("depth"),
            (F.col("total") + F.col("t")).alias("total")), "walk")  # finished messages are not joined again
        before = n
    return jumps, reduce(DataFrame.unionByName, done).select("id", "depth", "total")


def best_paths(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """tree, leaf, rank, score, id, depth: every message of the chosen root-to-leaf paths.

    messages: tree, id, parent, score. `branches` None keeps all leaves of every tree.
    """
    base = messages.select("tree", "id", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("value"))
    jumps, walked = pointers(base)
    inner = base.select(F.col("parent").alias("id")).filter(F.col("id").isNotNull()).distinct()
    leaves = base.select("tree", "id").join(walked, "id").join(inner, "id", "left_anti") \
        .withColumn("score", F.col("total") / F.col("depth"))
    order = Window.partitionBy("tree").orderBy(F.desc("score"), "id")
    leaves = leaves.withColumn("rank", F.row_number().over(order))
    if branches is not None:
        leaves = leaves.filter(F.col("rank") <= branches)
    paths = stored(leaves.select("tree", F.col("id").alias("leaf"), "rank", "score", "id"), "paths")
    for jump in jumps:  # ancestors 0 .. 2**k - 1 are there; these add the next 2**k
        above = paths.join(jump, "id").select("tree", "leaf", "rank", "score", F.col("up").alias("id"))
        paths = stored(paths.unionByName(above), "paths")
    return paths.join(walked.select("id", "depth"), "id")


def formatted(paths: DataFrame, texts: DataFrame) -> DataFrame:
    """One row per path: tree, leaf, rank, score, n_turns, formatted, loss (array of start, end in code points).

    texts: id, role, text. Escaping and lengths are worked out per message; a path only joins its pieces.
    """
    role, text = F.coalesce("role", F.lit("")), escaped(F.coalesce("text", F.lit("")))
    shown = F.when(role == "user", F.concat(F.lit("[INST] "), text, F.lit(" [/INST]"))) \
        .when(role == "system", F.concat(F.lit("<<SYS>> "), text, F.lit(" <</SYS>>"))) \
        .when(role == "assistant", F.concat(F.lit(" "), text, F.lit("</s>"))) \
        .otherwise(F.concat(F.lit("[ROLE] "), escaped(role), F.lit(" [/ROLE] "), text, F.lit(" [/TURN]")))
    pieces = texts.select("id", shown.alias("shown"), (role == "assistant").alias("learn"))
    turns = paths.join(pieces, "id").groupBy("tree", "leaf", "rank", "score").agg(F.sort_array(F.collect_list(
        F.struct("depth", "shown", "learn"))).alias("turns"))
    start = F.named_struct(F.lit("at"), F.lit(3), F.lit("spans"), F.expr("cast(array() as array<struct<start:int,end:int>>)"))
    loss = F.aggregate("turns", start, lambda have, t: F.struct(
        (have["at"] + F.length(t["shown"])).alias("at"),
        F.when(t["learn"], F.concat(have["spans"], F.array(F.struct(
            (have["at"] + 1).alias("start"), (have["at"] + F.length(t["shown"]) - 4).alias("end")))))
        .otherwise(have["spans"]).alias("spans")))
    return turns.select(
        "tree", "leaf", "rank", "score", F.size("turns").cast("long").alias("n_turns"),
        F.concat(F.lit("<s>"), F.array_join(F.transform("turns", lambda t: t["shown"]), "")).alias("formatted"),
        loss["spans"].alias("loss"))


def format_trees(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """messages: tree, id, parent, role, text, score -> one formatted conversation per chosen path."""
    return formatted(best_paths(messages, branches), messages.select("id", "role", "text"))


def linear(conversations: DataFrame) -> DataFrame:
    """Turns as reply trees without branches: each turn replies to the one before it."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit("none"))
    place = F.row_number().over(order)
    return conversations.select("conv_id", "turn", "role", "text").withColumn("place", place).select(
        F.col("conv_id").alias("tree"), F.concat_ws(":", key, F.format_string("%012d", "place")).alias("id"),
        F.when(F.col("place") > 1, F.concat_ws(":", key, F.format_string("%012d", F.col("place") - 1))).alias("parent"),
        "role", "text", F.lit(0.0).alias("score"))


def digests(chats: DataFrame) -> DataFrame:
    """What the formatted texts and loss masks hold, read back from them."""
    schema = "conv_id BIGINT, n_turns BIGINT, turns_sha256 STRING, loss_chars BIGINT, loss_sha256 STRING, " \
             "formatted_chars BIGINT"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for tree, text, spans in zip(*(batch.column(c).to_pylist() for c in ("tree", "formatted", "loss"))):
                turns = read_back(text)
                whole = hashlib.sha256("".join(f"{role}\n{said}\n" for role, said in turns).encode())
                learn = "".join(unescaped(text[s["start"]: s["end"]]) for s in spans)
                out.append((tree, len(turns), whole.hexdigest(), len(learn),
                            hashlib.sha256(learn.encode()).hexdigest(), len(text)))
            columns = list(zip(*out)) or [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [
                "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
    return chats.select("tree", "formatted", "loss").mapInArrow(read, schema)


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts hold control strings."""
    awkward = "</s>[INST] ok [/INST]"
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(awkward).alias("text"))
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return digests(format_trees(linear(talks)))
