"""Exact nearest binary codes by incremental multi-index hashing.

Codes are cut into segments, each indexed by its value. A round looks the queries' segments up
with all values that differ in exactly ``r`` bits. Codes further away than the rounds so far
can reach differ in more than ``r`` bits in every segment, so after round ``r`` over ``m`` segments
everything up to distance ``m * (r + 1) - 1`` has been seen. A query is done when its k-th
verified distance is within that; the others go on with ``r + 1``. Distances are verified inside
the join, against the k-th found so far: what cannot be a neighbour does not leave it.

Codes that occur often are one entry each, with the ``k + 1`` smallest ids: by the tie rule no
other can be an answer. For the same reason a query keeps the ``k + 1`` entries that are first by
distance and smallest id, however many share its segments or are as near; Spark limits them
before they are shuffled and gathered. The number of segments follows the number of codes, so a segment
value has a few codes at any size. All state is written tables, rounds are as few as bits of a
segment at most, and the driver sees counts only.

Defined cases: codes that are null, and ids that are null, take no part; rows with the same id
and code count once; if there are fewer than k other codes all of them are returned; ties go
to the smaller id; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import table, top_by
from skyledger.session import stage_table

BITS = 64
#: Segments are no wider: a round has at most C(16, 8) masks, more codes get longer lists instead.
WIDEST = 16
_FOUND = "array<struct<distance:int,first:long,code:long,size:int>>"


def sign_codes(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """id and the 64-bit code of the signs of a vector's first 64 components (bit i: component i is
    positive; missing ones count as 0). Null vectors, and vectors with null components, have no code."""
    first = F.slice(F.col(embedding), 1, BITS)
    powers = F.transform(first, lambda x, i: F.when(x > 0, F.element_at(_powers(), i + 1)).otherwise(F.lit(0).cast("long")))
    code = F.aggregate(powers, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    whole = ~F.exists(F.col(embedding), lambda x: x.isNull())
    return vectors.where(F.col(embedding).isNotNull() & whole).select(F.col(vec_id).cast("long").alias("id"), code.alias("code"))


def _powers() -> Column:
    return F.array(*[F.lit((1 << i) - (1 << 64 if i == 63 else 0)).cast("long") for i in range(BITS)])


def _segment(code: Column, segment: int, width: int) -> Column:
    return F.shiftrightunsigned(code, segment * width).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def widths(codes: int) -> int:
    """Bits of a segment: a power of two near the logarithm of the number of codes."""
    width = 8
    while width < 32 and 1 << (width + width // 2) <= codes:
        width *= 2
    return width


def nearest_codes(codes: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, id, distance): the k nearest of ``codes`` (id, code) for each row of ``queries``
    (id, code), not counting the row with the query's own id."""
    usable = codes.where("id is not null and code is not null").select("id", "code").distinct()
    entries = stage_table(
        top_by(usable, ["code"], [F.col("id")], k + 1, "n").groupBy("code").agg(
            F.sort_array(F.collect_list("id")).alias("ids")), "codes",
    )
    width = min(WIDEST, widths(entries.count()))
    segments = BITS // width
    pieces = F.array(*[F.struct(F.lit(s).alias("segment"), _segment(F.col("code"), s, width).alias("value"))
                       for s in range(segments)])
    index = stage_table(entries.select("code", F.element_at("ids", 1).alias("first"), F.size("ids").alias("size"),
                                       F.explode(pieces).alias("at")).select(
        "at.segment", "at.value", "code", "first", "size"), "segments")
    asked = stage_table(queries.where("id is not null and code is not null").select(
        F.col("id").alias("query_id"), "code").distinct(), "queries")
    # A query's own id may be among what it finds, so k + 1 are wanted of each code asked for.
    open_ = asked.select(F.col("code").alias("query")).distinct().withColumn("reach", F.lit(BITS))
    open_ = stage_table(open_.withColumn("found", F.array().cast(_FOUND)), "open")
    done: list[DataFrame] = []
    for radius in range(width + 1):
        masks = F.broadcast(entries.sparkSession.range(1 << width).where(F.bit_count("id") == radius).select(
            F.col("id").alias("mask")))
        probe = open_.select("query", "reach", F.explode(F.array(*[
            F.struct(F.lit(s).alias("segment"), _segment(F.col("query"), s, width).alias("own")) for s in range(segments)
        ])).alias("at")).select("query", "reach", "at.segment", "at.own")
        probe = probe.crossJoin(masks).select(
            "query", "reach", "segment", F.col("own").bitwiseXOR(F.col("mask")).alias("value"))
        # The probes of a round are many more than their source lets Spark guess: never broadcast.
        hits = probe.hint("merge").join(index.hint("merge"), ["segment", "value"]).where(distance(F.col("query"), F.col("code")) <= F.col("reach"))
        # Each code once: not if an earlier round saw it, and by the first segment that finds it in this one.
        apart = [distance(_segment(F.col("query"), s, width), _segment(F.col("code"), s, width)) for s in range(segments)]
        hits = hits.where(F.array_position(F.array(*apart), radius) == F.col("segment") + 1).where(
            F.least(*apart) == radius)
        new = hits.select("query", F.struct(distance(F.col("query"), F.col("code")).alias("distance"), "first", "code",
                                            "size").alias("hit"))
        old = open_.select("query", F.explode("found").alias("hit"))
        gathered = top_by(new.union(old), ["query"], [F.col("hit.distance"), F.col("hit.first")], k + 1, "at")
        gathered = gathered.withColumn("n", F.sum("hit.size").over(_by_distance()) - F.col("hit.size"))
        # Entries up to the one that completes k + 1 ids, and those of these as near as it.
        cut = gathered.groupBy("query").agg(
            F.min(F.when(F.col("n") + F.col("hit.size") >= k + 1, F.col("hit.distance"))).alias("kth"),
            F.array_sort(F.collect_list("hit")).alias("found"),
        )
        state = open_.select("query").join(cut, "query", "left").select(
            "query", F.coalesce("kth", F.lit(BITS)).alias("reach"),
            F.filter(F.coalesce("found", F.array().cast(_FOUND)),
                     lambda h: h["distance"] <= F.coalesce(F.col("kth"), F.lit(BITS))).alias("found"),
        )
        state = stage_table(state, "round")
        covered = segments * (radius + 1) - 1
        finished = F.lit(True) if radius == width else F.col("reach") <= covered
        done.append(state.where(finished))
        open_ = state.where(~finished)
        if open_.isEmpty():
            break
    found = done[0]
    for more in done[1:]:
        found = found.union(more)
    hits = asked.join(found, asked["code"] == found["query"]).select("query_id", F.explode("found").alias("hit"))
    members = entries.select("code", "ids")
    each = hits.select("query_id", "hit.distance", "hit.code").join(members, "code").select(
        "query_id", "distance", F.explode("ids").alias("id")).where("id <> query_id")
    ranked = top_by(each, ["query_id"], [F.col("distance"), F.col("id")], k, "rank")
    return ranked.select("query_id", "rank", "id", F.col("distance").cast("int").alias("distance"))


def _by_distance():
    from pyspark.sql import Window

    return Window.partitionBy("query").orderBy("hit.distance", "hit.first", "hit.code")


NEAREST = 10


def op10_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest sign codes of each embedding whose id is divisible by 100."""
    codes = stage_table(sign_codes(table(spark, sf_dir, "embeddings")), "sign_codes")
    found = nearest_codes(codes, codes.where("id % 100 = 0"), NEAREST)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "distance")
