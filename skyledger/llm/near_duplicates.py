"""Near-duplicate documents by bottom-k sketches.

A document is the set of its shingles, hashed by one function. Its sketch is the k least hashes.

1. Equal sets are one representative from here on; thousands of copies cost one.
2. The sketches are inverted: each retained value lists who has it. Values that one set alone has make no
   pair. Of the others a set only needs its rarest: two sets as alike as asked share at least
   ``s`` of their sketch values, so they share one of the ``size - s + 1`` rarest. Sets of little
   shared text have none left and are done; a passage that many documents share drops out.
3. In each list the member with the fewest values of its own is the pivot, and the others pair up
   with it: pairs grow with the members of a list, not with their square. The sketch of the
   union estimates a pair's similarity; pairs that may reach the threshold, five standard
   deviations allowed, are verified on full sets.
4. Members that did not link with their pivot are compared with the members of its star,
   by the same filter and the same verification inside the join, so that only links leave it.
   Members that are both linked with the pivot are in one component already. Both sides of a big star
   are cut into blocks by a hash of the member; each pair of blocks is a key of its own.
5. Links are contracted to components by alternating large-star and small-star steps.

For sets that fit into the sketch the bound ``s`` is exact; for larger ones a link is lost if a sample
of k is off by five standard deviations in the wrong direction (odds under one in a million).

Words are runs of anything but ASCII white space, with A-Z in lower case. Defined cases: a
document without words, or with a null text, has no shingles, links with nothing and is kept;
one with fewer words than a shingle is one shingle; repeated rows are copies of each other;
a null doc_id comes after all others when the component's smallest id is taken, and a component of
nulls has a null id; ties do not arise, ids and row numbers order everything; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import table
from skyledger.session import stage_table

WORDS = 5
SKETCH = 64
STAR_BLOCK = 256
#: Tasks that compare blocks: as many as there are full pairs of blocks, but not more than this.
STAR_TASKS = 2000
_SETS = "row long, doc_id long, n_shingles long, set_key binary, sketch array<long>"
_FULL = "set_key binary, shingles array<long>"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    raw = hashlib.shake_256(b"byte values").digest(256 * 8)
    return np.frombuffer(raw, "<u8") | np.uint64(1)


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]))
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(text: bytes, words: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles, as signed integers."""
    if not text:
        return np.zeros(0, np.int64)
    raw = _LOWER[np.frombuffer(text, np.uint8)]
    inside = ~_SPACE[raw]
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    starts, ends = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
    if not len(starts):
        return np.zeros(0, np.int64)
    powers, inverse = _power_table(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_byte_values()[raw] * powers[: len(raw)], dtype=np.uint64, out=sums[1:])
    word = _mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    size = min(words, len(word))
    rows = len(word) - size + 1
    shingle = np.full(rows, size, np.uint64)
    for i in range(size):
        shingle = _mixed(shingle * np.uint64(_BASE) + word[i:i + rows])
    return np.unique(shingle.view(np.int64))


def _key(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _bytes_of(column: pa.Array) -> list:
    return column.cast(pa.binary()).to_pylist()


def shingle_sets(documents: DataFrame, words: int = WORDS, k: int = SKETCH, key: str | None = None) -> DataFrame:
    """Size, key and sketch of each document's set, under a number of its own: the column ``key``, if there is one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                sets = [shingle_hashes(text or b"", words) for text in _bytes_of(some.column(1))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(row, row + len(sets)), pa.int64()) if key is None else some.column(2), some.column(0),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([_key(s) if len(s) else None for s in sets], pa.binary()),
                     pa.array([s[:k] for s in sets], pa.list_(pa.int64()))],
                    names=["row", "doc_id", "n_shingles", "set_key", "sketch"],
                )
                row += len(sets)

    keys = [] if key is None else [F.col(f"`{key}`").cast("long").alias("row")]
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *keys)
    return rows.mapInArrow(run, _SETS)


def full_sets(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """Key and all shingles of each document's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                sets = [shingle_hashes(text or b"", words) for text in _bytes_of(batch.slice(at, 64).column(0))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_key(s) for s in sets], pa.binary()), pa.array(sets, pa.list_(pa.int64()))],
                    names=["set_key", "shingles"],
                )

    return documents.select(F.col("text").cast("string")).mapInArrow(run, _FULL)


def least_shared(size: int, percent: int) -> int:
    """Values of a sketch of ``size`` that sets of the asked similarity share at the very least."""
    share = percent / 100
    return max(1, math.floor(size * share - 5 * math.sqrt(size * share * (1 - share))))


def _postings(sets: DataFrame, percent: int, k: int) -> DataFrame:
    """(value, rep, own): the rarest shared values of each set; ``own`` is the share of its sketch
    that no other set has."""
    # A set of n can only be like another one if n / (n + 1) reaches the threshold.
    least = math.ceil(percent / (100 - percent)) if percent < 100 else 1 << 62
    large = sets.where(F.col("n_shingles") >= least)
    entries = large.select(F.col("row").alias("rep"), F.explode("sketch").alias("value"))
    lists = entries.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    # The shared values grow with the corpus: never broadcast, whatever they are estimated at.
    shared = entries.join(lists.hint("merge"), "value")
    sizes = large.select(F.col("row").alias("rep"), "n_shingles", F.size("sketch").alias("size"))
    small = F.col("n_shingles") * 100 <= percent * k
    need = F.when(small, F.ceil(F.col("n_shingles") * percent / 100)).otherwise(least_shared(k, percent))
    by_rep = Window.partitionBy("rep")
    own = F.col("size") - F.count("*").over(by_rep)
    ranked = shared.join(sizes.hint("merge"), "rep").select(
        "value", "rep", (own / F.col("size")).alias("own"), (F.col("size") - need + 1 - own).alias("wanted"),
        F.row_number().over(by_rep.orderBy("df", "value")).alias("rank"),
    )
    return ranked.where("rank <= wanted").select("value", "rep", "own")


def _may_link(a: Column, b: Column, percent: int, k: int) -> Column:
    """Whether the sketch of the union leaves the asked similarity possible."""
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, k)
    shared = F.size(F.array_intersect(F.array_intersect(a, b), union))
    bounds = F.array(*[F.lit(least_shared(n, percent) if n else 0) for n in range(k + 1)])
    return shared >= F.element_at(bounds, F.size(union) + 1)


def _linked(a: Column, b: Column, percent: int) -> Column:
    """Whether two full sets are as alike as asked."""
    both = F.size(F.array_intersect(a, b))
    return both * 100 >= (F.size(a) + F.size(b) - both) * percent


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that links (a, b) touch; the root is its component's least node."""
    edges = stage_table(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(
            "u <> v").distinct()
        near = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(near, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage_table(
            small.unionByName(near.select("u", F.col("m").alias("v"))).distinct(), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def near_duplicates(
    documents: DataFrame, *, percent: int = 85, words: int = WORDS, k: int = SKETCH, key: str | None = None
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, ``first``: true for one row of each component, and ``row``.
    Sets are linked if 100 * intersection >= percent * union. ``key`` names a column of distinct integers
    that comes back as ``row``; without one, rows are numbered."""
    sets = stage_table(shingle_sets(documents, words, k, key), "sets")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    # The sketch comes with the representative: an aggregate moves the same bytes at every size, a join
    # back to the sets would be broadcast while small and move all of them later.
    reps = stage_table(
        sets.where("set_key is not null").groupBy("set_key").agg(
            F.min("row").alias("rep"), F.min(place).alias("least"), F.min_by("sketch", "row").alias("sketch"),
            F.min("n_shingles").alias("n_shingles")),
        "representatives",
    )
    single = reps.select(F.col("rep").alias("row"), "n_shingles", "sketch")
    postings = stage_table(_postings(single, percent, k), "postings")
    pivots = postings.groupBy("value").agg(F.min(F.struct("own", "rep")).alias("p"))
    stars = stage_table(
        postings.join(pivots, "value").select("rep", F.col("p.rep").alias("pivot")).where("rep <> pivot").distinct(),
        "stars_of_lists",
    )
    touched = stars.select("rep").unionByName(stars.select(F.col("pivot").alias("rep"))).distinct()
    wanted = stage_table(
        reps.join(touched.hint("merge"), "rep").select("rep", "set_key", F.col("least.doc_id").alias("doc_id")), "wanted")
    ids = wanted.select(F.col("doc_id").alias("id")).distinct()
    again = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    shingles = full_sets(again, words).join(wanted, "set_key").dropDuplicates(["rep"])
    full = stage_table(shingles.select("rep", "shingles"), "full_sets")

    one = full.select("rep", F.col("shingles").alias("a"))
    other = full.select(F.col("rep").alias("pivot"), F.col("shingles").alias("b"))
    head = lambda c: F.slice(c, 1, k)
    a, b = F.col("a"), F.col("b")
    alike = _may_link(head(a), head(b), percent, k) & _linked(a, b, percent)
    checked = stage_table(
        stars.join(one, "rep").join(other, "pivot").select("rep", "pivot", F.when(alike, True).otherwise(False).alias("linked")),
        "checked",
    )
    rest = _rest_links(checked, full, percent, k)
    links = checked.where("linked").select(F.col("rep").alias("a"), F.col("pivot").alias("b")).unionByName(rest)
    roots = components(links)

    classes = reps.join(roots, reps["rep"] == roots["node"], "left").select(
        "set_key", F.coalesce("root", "rep").alias("root"), "least")
    firsts = classes.groupBy("root").agg(F.min("least").alias("first"))
    found = classes.join(firsts, "root").select(F.col("set_key").alias("key"), F.col("first"))
    joined = sets.select("row", "doc_id", "n_shingles", "set_key").join(found, F.col("set_key") == F.col("key"), "left")
    alone = F.col("first").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id"))
    return joined.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
        F.when(alone, True).otherwise(F.col("first.row") == F.col("row")).alias("first"), "row",
    )


def _rest_links(checked: DataFrame, full: DataFrame, percent: int, k: int) -> DataFrame:
    """Links (a, b) between members of a star of which at least one is not linked with the pivot."""
    cut = lambda n: F.ceil(n / STAR_BLOCK).cast("int")
    stars = checked.groupBy("pivot").agg(
        F.count("*").cast("double").alias("members"), F.sum(F.when(F.col("linked"), 0).otherwise(1)).alias("apart")
    ).where("apart > 0")  # stars with all members linked are done
    pairs = stars.agg(F.ceil(F.sum(F.col("members") * F.col("apart")) / STAR_BLOCK**2)).first()[0] or 0
    # The number of tasks is fixed: a hot partition split on both sides would become the product of its splits.
    tasks = max(int(checked.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(pairs, STAR_TASKS))
    members = checked.join(
        stars.select("pivot", cut(F.col("members")).alias("blocks"), cut(F.col("apart")).alias("slots")), "pivot"
    ).join(full, "rep")
    place = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = members.select(
        "pivot", place("blocks").alias("block"), every("slots").alias("slot"), F.col("rep").alias("a"),
        F.col("linked").alias("a_linked"), F.col("shingles").alias("a_set"))
    right = members.where("not linked").select(
        "pivot", every("blocks").alias("block"), place("slots").alias("slot"), F.col("rep").alias("b"),
        F.col("shingles").alias("b_set"))
    key = ["pivot", "block", "slot"]
    left, right = left.repartition(tasks, *key), right.repartition(tasks, *key)
    a, b = F.col("a_set"), F.col("b_set")
    on = (
        (left["pivot"] == right["pivot"]) & (left["block"] == right["block"]) & (left["slot"] == right["slot"])
        & (F.col("a") != F.col("b")) & (F.col("a_linked") | (F.col("a") < F.col("b")))
        & (F.least(F.size(a), F.size(b)) * 100 >= F.greatest(F.size(a), F.size(b)) * percent)
        & _may_link(F.slice(a, 1, k), F.slice(b, 1, k), percent, k) & _linked(a, b, percent)
    )
    # Both sides hold full sets and grow with the corpus: the same join at every size.
    return left.join(right.hint("merge"), on).select("a", "b").distinct()


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")
