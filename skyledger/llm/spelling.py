"""Spelling variants: words one edit apart, found by a frontier of states over a trie kept as a table.

The trie is a table of edges (node, first character, label, child). Chains without a branch are
one edge with a longer label, so a level is a branching, not a character, and long words take no
more levels than short ones. A node is named by its prefix. Levels are built by grouping words by
(node, next character): the longest common prefix of a group's least and greatest word is its child.

A state is (word, position, node, edits). All words walk their own path with no edit. A pair of words
one edit apart parts where its longest common prefix ends, or, read backwards, where its longest
common suffix ends; one of the two is at least half of the word. So words and reversed words each
have a trie, and a state makes its edit only in the second half of a word, where nodes have few
edges: the replaced or inserted character leads onto an edge that does not go on with the word. From
there states advance edge by edge, joined by (node, next character); those that end their word on a
terminal node are neighbours. Replacements start at the word with the smaller character and
deletions are insertions read from the other word, so each pair is met from one side and mirrored.

Every level is written to the shared folder. Words are grouped before they are joined, so a hot
node sends rows of a join that adaptive execution splits, never a group to one task.

Defined cases: null and empty texts have no words; a null doc_id counts as an empty one; repeated rows
count as often as they occur; a word without near words has none of a form; ties go to the word first
in code-point order; an empty table has no words; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import ascii_lower, narrow, table
from skyledger.session import stage_table

RUN = "A-Za-z\\x{C0}-\\x{FF}"
#: One word in so many loses a character, by a hash of document and word.
DAMAGED = 97
LEAST_POINTS = 5
LEAST_COUNT = 3


def _hash(word: Column, doc_id: Column) -> Column:
    return F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))


def damage(word: Column, doc_id: Column, every: int) -> Column:
    """``word`` without one character where the hash of document and word is a multiple of ``every``."""
    h = _hash(word, doc_id)
    at = (h % F.length(word)).cast("int")
    cut = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    return F.when(h % every == 0, cut).otherwise(word)


def words(
    documents: DataFrame, *, every: int = DAMAGED, least_points: int = LEAST_POINTS, least_count: int = LEAST_COUNT
) -> DataFrame:
    """word and n (occurrences in all texts) of the words that are long and frequent enough."""
    # Shorter runs are not even cut out: damage takes one character at most. (A filter on the damaged word would be
    # pushed below it and hash every run twice.)
    pattern = F.lit(f"[{RUN}]{{{max(1, least_points)},}}")
    runs = narrow(documents, ["doc_id", "text"]).select(
        "doc_id", F.explode(F.regexp_extract_all(ascii_lower(F.col("text").cast("string")), pattern, F.lit(0))).alias("run")
    )
    whole = _hash(F.col("run"), F.col("doc_id")) % every != 0
    return (
        runs.where((F.length("run") > least_points) | whole)
        .select(damage(F.col("run"), F.col("doc_id"), every).alias("word"))
        .groupBy("word").agg(F.count("*").alias("n"))
        .where(F.col("n") >= least_count)
    )


def _shared(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two different strings, neither a prefix of a prefix of the other."""
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.coalesce(x == y, F.lit(False)))
    at = F.array_position(same, False)
    return F.when(at > 0, at - 1).otherwise(F.least(F.length(a), F.length(b))).cast("int")


def trie(items: DataFrame, start: int) -> tuple[DataFrame, DataFrame]:
    """(edges, states) of the distinct strings ``item`` of each ``side``; nodes are prefixes of ``start``
    characters at least. ``states``: the nodes on the path of each item, as far as they have edges."""
    active = stage_table(items.select("side", "item", F.lit(start).alias("at")), "trie_items")
    edges, states = [], [active]
    while not (walking := active.where(F.length("item") > F.col("at"))).isEmpty():
        keyed = walking.withColumn("key", F.expr("left(item, at + 1)"))
        groups = keyed.groupBy("side", "key").agg(F.min("item").alias("low"), F.max("item").alias("high"))
        depth = F.when(F.col("low") == F.col("high"), F.length("low")).otherwise(_shared(F.col("low"), F.col("high")))
        groups = stage_table(
            groups.withColumn("depth", depth).select(
                "side", "key", F.expr("left(key, length(key) - 1)").alias("node"), F.expr("right(key, 1)").alias("first"),
                F.expr("substring(low, length(key), depth - length(key) + 1)").alias("label"),
                F.expr("left(low, depth)").alias("child"), "depth", (F.length("low") == F.col("depth")).alias("word"),
                (F.col("low") == F.col("high")).alias("leaf"),
            ), "trie_edges",
        )
        edges.append(groups)
        inner = groups.where("not leaf").select("side", "key", F.col("depth").alias("to"))
        active = stage_table(
            keyed.join(inner, ["side", "key"]).select("side", "item", F.col("to").alias("at")), "trie_states"
        )
        states.append(active)
    return _all(edges), _all(states)


def _all(frames: list[DataFrame]) -> DataFrame | None:
    whole = None
    for frame in frames:
        whole = frame if whole is None else whole.unionByName(frame)
    return whole


def near_words(found: DataFrame) -> DataFrame:
    """word and near: all ordered pairs of the distinct strings ``word`` that one inserted, deleted or
    replaced character parts."""
    least = found.agg(F.min(F.length("word")).alias("least")).first()["least"]
    sides = found.select(F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("word").alias("item")),
        F.struct(F.lit(1).alias("side"), F.reverse("word").alias("item")),
    )).alias("s")).select("s.*")
    # Half of the shortest word: no state makes its edit above.
    edges, states = trie(sides, (least or 0) // 2)
    nothing = found.select("word", F.col("word").alias("near")).limit(0)
    if edges is None:
        return nothing
    steps = edges.select("side", "node", "first", "label", "child", F.col("word").alias("ends"))
    frontier = _edited(states, steps)
    met = []
    while not frontier.isEmpty():
        met.append(frontier.where((F.length("item") == F.col("at")) & F.col("ends")).select("side", "item", F.col("node").alias("other")))
        going = frontier.where(F.length("item") > F.col("at")).drop("ends").withColumn("first", F.expr("substring(item, at + 1, 1)"))
        frontier = stage_table(
            going.join(steps, ["side", "node", "first"])
            .where("substring(item, at + 1, length(label)) = label")
            .select("side", "item", (F.col("at") + F.length("label")).alias("at"), F.col("child").alias("node"), "ends"),
            "frontier",
        )
    if not met:
        return nothing
    turned = lambda name: F.when(F.col("side") == 0, F.col(name)).otherwise(F.reverse(name))
    once = _all(met).select(turned("item").alias("a"), turned("other").alias("b")).distinct()
    both = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near")),
                   F.struct(F.col("b").alias("word"), F.col("a").alias("near")))
    return once.select(F.explode(both).alias("p")).select("p.*")


def _edited(states: DataFrame, steps: DataFrame) -> DataFrame:
    """The states after one edit, made where the word leaves the path it shares with a neighbour."""
    branch = (
        states.where("2 * at >= length(item) - 1")
        .withColumn("node", F.expr("left(item, at)"))
        .join(steps, ["side", "node"])
        .where("first <> substring(item, at + 1, 1)")
    )
    rest = "substring(label, 2)"
    replaced = F.expr(f"first > substring(item, at + 1, 1) and at < length(item) and substring(item, at + 2, length(label) - 1) = {rest}")
    inserted = F.expr(f"2 * at >= length(item) and substring(item, at + 1, length(label) - 1) = {rest}")
    moves = F.array_compact(F.array(
        F.when(replaced, F.col("at") + F.length("label")), F.when(inserted, F.col("at") + F.length("label") - 1)
    ))
    return stage_table(
        branch.where(replaced | inserted)
        .select("side", "item", F.explode(moves).alias("at"), F.col("child").alias("node"), "ends"),
        "frontier",
    )


def forms(found: DataFrame, near: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n for the words and their near pairs."""
    # Each word meets its neighbours' counts once; a struct orders by count, then by the word itself.
    best = near.join(found.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").groupBy("word").agg(
        F.count("*").alias("n_near"), F.max("near_n").alias("most"),
        F.min_by("near", F.struct((-F.col("near_n")).alias("a"), F.col("near").alias("b"))).alias("best"),
    )
    is_form = F.col("most") >= 2 * F.col("n")
    judged = stage_table(
        found.join(best, "word", "left").select(
            "word", F.when(is_form, F.col("best")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, F.col("most")).alias("form_n"),
        ), "forms",
    )
    roots = judged.where("form is not null").select("word", F.col("form").alias("root"))
    while True:  # counts at least double along a chain, so it has no cycle and few steps
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = stage_table(
            roots.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                      F.col("further").isNotNull().alias("moved")), "roots")
        roots = step.drop("moved")
        if step.where("moved").isEmpty():
            break
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(documents: DataFrame, **limits) -> DataFrame:
    """The words of ``documents``, each with its most frequent near word, if that is twice as frequent."""
    found = stage_table(words(documents, **limits), "words")
    return forms(found, near_words(found))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))
