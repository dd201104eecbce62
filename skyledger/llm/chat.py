"""Reply trees to formatted conversations, with DataFrame operations only.

Messages of a tree name their parent. Self-joins by doubling find each message's ancestor 1, 2,
4, ... steps up together with the score of the steps in between; after the logarithm of the
depth every message knows the score of its path from the root. Leaves are ranked by that
score, and the kept ones walk the same tables downwards in size: each join adds half as many
ancestors again, each exactly once. A level costs one join of ids, whatever the depth; texts
are joined once, to the chosen paths alone.

The template marks turns with control strings. Inside roles and texts every control string,
of this template and of other usual ones, gets a backslash before its last part, one more than
it had; reading back removes one.

Defined cases: a null text or role counts as empty; a null score as 0; a null tree is a tree of
its own; messages without an id are left out, they have no place in a tree; of messages
with the same tree and id the least by parent, role and text counts; a parent that the
tree does not have makes a root; messages on a cycle have no path from a root and are left out;
ties of paths go to the smaller leaf id; an empty table gives no conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import narrow, table, top_by
from skyledger.session import stage_table

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
LEARNED = "assistant"
# Control strings: an opening, backslashes if escaped, and a rest that holds no bracket but the last.
_OPEN, _REST = r"(<<?/?|\[/?)", r"(\|[a-z_]+\|>|s>|SYS>>|INST\])"
CONTROL = _OPEN + r"(\\*)" + _REST
ESCAPED = _OPEN + r"\\(\\*)" + _REST


def escape(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _same(left: str, right: str, left_id: str, right_id: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right)) & (F.col(left_id) == F.col(right_id))


def reply_paths(messages: DataFrame, keep: int | None = 1) -> DataFrame:
    """(tree, leaf, score, id, steps): the messages of the ``keep`` best root-to-leaf paths of each
    tree, all if None; ``steps`` counts from the leaf. ``messages`` has tree, id, parent, score."""
    rows = messages.where("id is not null")
    known = rows.select(F.col("tree").alias("t"), F.col("id").alias("i"))
    nodes = stage_table(
        rows.join(known, _same("tree", "t", "parent", "i"), "left").select(
            "tree", "id", F.col("i").alias("up"), F.coalesce("score", F.lit(0.0)).cast("double").alias("score")
        ),
        "nodes",
    )
    levels = [nodes]
    most = nodes.count().bit_length() + 1
    while len(levels) <= most and not levels[-1].where("up is not null").isEmpty():
        low = levels[-1]
        high = low.select(F.col("tree").alias("t"), F.col("id").alias("i"), F.col("up").alias("u"),
                          F.col("score").alias("s"))
        # Only messages deeper than the steps so far go on; one deep tree costs the others nothing.
        further = low.where("up is not null").join(high, _same("tree", "t", "up", "i"), "left").select(
            "tree", "id", F.col("u").alias("up"), (F.col("score") + F.coalesce("s", F.lit(0.0))).alias("score"))
        levels.append(stage_table(further.unionByName(low.where("up is null")), "ancestors"))
    parents = nodes.where("up is not null").select(F.col("tree").alias("t"), F.col("up").alias("i")).distinct()
    leaves = levels[-1].where("up is null").join(parents, _same("tree", "t", "id", "i"), "left_anti")
    if keep is not None:
        leaves = top_by(leaves, ["tree"], [F.col("score").desc(), F.col("id").asc()], keep, "n")
    path = leaves.select("tree", F.col("id").alias("leaf"), F.col("score").alias("path_score"), "id",
                         F.lit(0).cast("long").alias("steps"))
    for k in range(len(levels) - 2, -1, -1):
        jump = levels[k].select(F.col("tree").alias("t"), F.col("id").alias("i"), "up")
        both = F.array(F.struct("id", "steps"), F.struct(F.col("up").alias("id"), (F.col("steps") + (1 << k)).alias("steps")))
        path = path.join(jump, _same("tree", "t", "id", "i")).select(
            "tree", "leaf", "path_score", F.explode(both).alias("at")
        ).select("tree", "leaf", "path_score", "at.id", "at.steps").where("id is not null")
    return path


def format_paths(messages: DataFrame, keep: int | None = 1) -> DataFrame:
    """One row a chosen path: tree, leaf, score, formatted, loss (spans of code points, end
    exclusive, over the texts the assistant is to learn). ``messages`` has tree, id, parent, role,
    text and score."""
    wanted = narrow(messages, ["tree", "id", "parent", "role", "text", "score"])
    same = Window.partitionBy("tree", "id").orderBy("parent", "role", "text")
    single = wanted.withColumn("n", F.row_number().over(same)).where("n = 1").drop("n")
    path = reply_paths(single.select("tree", "id", "parent", "score"), keep)
    said = single.select(F.col("tree").alias("t"), F.col("id").alias("i"), "role", "text")
    turns = path.join(said, _same("tree", "t", "id", "i")).select(
        "tree", "leaf", "path_score",
        F.struct((-F.col("steps")).alias("place"), escape(F.col("role")).alias("role"),
                 F.coalesce(F.col("role") == LEARNED, F.lit(False)).alias("learned"),
                 escape(F.col("text")).alias("text")).alias("turn"),
    )
    grouped = turns.groupBy("tree", "leaf", "path_score").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    formatted = F.array_join(
        F.transform("turns", lambda t: F.concat(F.lit(TURN), t["role"], F.lit(TEXT), t["text"], F.lit(END))), ""
    )
    around = len(TURN) + len(TEXT)
    none = F.array().cast("array<struct<start:int,stop:int>>")

    def add(at: Column, t: Column) -> Column:
        start = at["at"] + around + F.length(t["role"])
        stop = start + F.length(t["text"])
        one = F.array(F.struct(start.alias("start"), stop.alias("stop")))
        return F.struct((stop + len(END)).alias("at"),
                        F.when(t["learned"], F.concat(at["spans"], one)).otherwise(at["spans"]).alias("spans"))

    loss = F.aggregate("turns", F.struct(F.lit(0).alias("at"), none.alias("spans")), add, lambda at: at["spans"])
    return grouped.select("tree", "leaf", F.col("path_score").alias("score"), formatted.alias("formatted"),
                          loss.alias("loss"))


def read_turns(formatted: Column) -> Column:
    """The (role, text) pairs that a formatted conversation holds."""
    parts = F.filter(F.split(formatted, r"<\|turn\|>"), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(
        unescape(F.substring_index(p, TEXT, 1)).alias("role"),
        unescape(F.substring_index(F.substring_index(p, TEXT, -1), END, 1)).alias("text"),
    ))


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescape(
        F.substring(formatted, s["start"] + 1, s["stop"] - s["start"]))), "")


def linear(conversations: DataFrame) -> DataFrame:
    """Rows by turn as trees without branches."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    at = narrow(conversations, ["conv_id", "turn", "role", "text"]).withColumn("id", F.row_number().over(order).cast("long"))
    return at.select(F.col("conv_id").alias("tree"), "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"),
                     "role", "text", F.lit(0.0).alias("score"))


#: Texts that look like a template's own marks.
HOSTILE = "</s>[INST] ok [/INST]"


def op4_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.createDataFrame([(-1, 0, "user", HOSTILE), (-1, 1, "assistant", HOSTILE)],
                                "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    messages = stage_table(linear(rows), "messages")
    out = stage_table(format_paths(messages), "formatted")
    read = out.select("tree", "formatted", read_turns(F.col("formatted")).alias("turns"),
                      read_loss(F.col("formatted"), F.col("loss")).alias("learned"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"), F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )
