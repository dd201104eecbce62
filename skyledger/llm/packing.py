"""Mixture-controlled packing of tokenized documents into fixed windows.

Every source is a queue of whole documents. Deficit round-robin serves the queues, a round a window: in
each round a queue's deficit grows by its quantum, its target share of a window; it sends the documents at
its head that the deficit covers and carries the rest to the next round. Windows are cut from the stream
that the rounds make, so they hold the target proportions to within the document each queue still saves
up for, whatever partition its documents come from; documents are cut only where a window ends.

A document leaves in the first round whose deficits, added up, cover its queue up to its end. Its round
is therefore a function of its place in its queue, and tasks compute it without talking to each other:
deficits carry across windows and partitions as numbers. The queue order is (partition, row) of the
tokenized table; sums per partition and source give a document's place. Its place in the stream is a running
total over the documents by (round, source, row), summed within runs of ``ROUNDS`` rounds, which hold about as many
tokens each, and over the totals of these runs. Only these numbers are sorted; ids are shuffled once.

When a queue runs dry the others share its part from the next round on. Nothing is dropped:
targets that the corpus cannot meet to the end hold as long as the queues last.

Defined cases: a null text counts as empty and still has its end token; a null source is a
queue of its own; repeated rows are packed as often as they occur; an empty table gives no
pieces; strings of special tokens in a text are those tokens, as the library reads them by default; other
columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import narrow
from skyledger.llm.encoders import byte_level, byte_level_tokens
from skyledger.session import stage_table

WINDOW = 2048
END_ID = 1
#: Deficits are integers of this many parts of a token: exact, and alike on every machine.
UNIT_BITS = 16

#: Rounds whose documents one task puts in order.
ROUNDS = 64

_TOKENS = "part int, row long, doc_id long, source string, tokens long, before long, ids binary"
_PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def tokenize(documents: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Ids (little-endian, two bytes if the vocabulary allows) of each whole text and the end id;
    ``before`` counts the tokens of the same source earlier in the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encode, kind = TaskContext.get().partitionId(), byte_level(tokenizer, True), _id_type(tokenizer)
        sent: dict[str | None, int] = {}
        row = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                sources = some.column(1).to_pylist()
                ids = [np.array([*encode(text or ""), end_id], kind).tobytes() for text in some.column(2).to_pylist()]
                counts = [len(one) // kind.itemsize for one in ids]
                before = []
                for source, count in zip(sources, counts):
                    before.append(sent.get(source, 0))
                    sent[source] = before[-1] + count
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * n, pa.int32()), pa.array(range(row, row + n), pa.int64()),
                     some.column(0), some.column(1), pa.array(counts, pa.int64()),
                     pa.array(before, pa.int64()), pa.array(ids, pa.binary())],
                    names=["part", "row", "doc_id", "source", "tokens", "before", "ids"],
                )
                row += n

    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInArrow(run, _TOKENS)


def _id_type(tokenizer: str) -> np.dtype:
    return np.dtype("<u2") if len(byte_level_tokens(tokenizer)) <= 1 << 16 else np.dtype("<u4")


class Schedule:
    """The round in which a queue's deficits cover it up to some token.

    A phase is a run of rounds with the same queues; there are at most as many phases as
    queues. Everything here is as large as the number of sources squared, not the corpus.
    """

    def __init__(self, totals: Mapping[str | None, int], targets: Mapping[str | None, float] | None, window: int):
        self.sources = sorted(totals, key=lambda s: (s is None, s))
        left = [totals[s] for s in self.sources]
        share = [float((targets or totals).get(s) or 0) for s in self.sources]
        n, passed = len(left), 0
        served, deficit = [0] * n, [0] * n
        self.phases: list[dict] = []
        while any(left):
            active = [i for i in range(n) if left[i]]
            whole = sum(share[i] for i in active)
            quantum = [0] * n
            for i in active:
                part = share[i] / whole if whole else 1 / len(active)
                quantum[i] = max(1, round(part * window * (1 << UNIT_BITS)))
            rounds = min(-(-((left[i] << UNIT_BITS) - deficit[i]) // quantum[i]) for i in active)
            self.phases.append({"served": served[:], "quantum": quantum, "deficit": deficit[:], "passed": passed})
            covered = [min(left[i], (deficit[i] + rounds * quantum[i]) >> UNIT_BITS) for i in range(n)]
            deficit = [(deficit[i] + rounds * quantum[i] - (covered[i] << UNIT_BITS)) if left[i] > covered[i] else 0
                       for i in range(n)]
            served = [a + b for a, b in zip(served, covered)]
            left = [a - b for a, b in zip(left, covered)]
            passed += rounds
        self.rounds = passed
        self.index = {source: i for i, source in enumerate(self.sources)}

    def round_of(self, source, last: np.ndarray) -> np.ndarray:
        """The round, from 1, that covers the first ``last`` tokens of a queue."""
        queue, out = self.index[source], np.zeros(len(last), np.int64)
        for phase in self.phases:
            quantum = phase["quantum"][queue]
            if quantum:
                later = last > phase["served"][queue]
                need = ((last[later] - phase["served"][queue]) << UNIT_BITS) - phase["deficit"][queue]
                out[later] = phase["passed"] + np.maximum(1, -(-need // quantum))
        return out


def pack(
    documents: DataFrame,
    tokenizer: str,
    *,
    targets: Mapping[str | None, float] | None = None,
    window: int = WINDOW,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of documents and where they lie; ``ids`` are little-endian unsigned 32-bit.

    ``documents`` needs doc_id, source and text. ``targets`` are the wanted token shares by
    source (any scale); without them each source has its share of the corpus, and all queues
    last to the end. A source without a target comes after those with one.
    """
    tokens = stage_table(
        tokenize(narrow(documents, ["doc_id", "source", "text"]), tokenizer, end_id), "tokens"
    )
    return pack_tokens(tokens, tokenizer, targets=targets, window=window, with_ids=with_ids)


def pack_tokens(
    tokens: DataFrame,
    tokenizer: str,
    *,
    targets: Mapping[str | None, float] | None = None,
    window: int = WINDOW,
    with_ids: bool = True,
) -> DataFrame:
    """``pack`` over a written result of ``tokenize``."""
    sums = tokens.groupBy("part", "source").agg(F.sum("tokens").alias("tokens"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage_table(
        sums.withColumn("first", F.coalesce(F.sum("tokens").over(earlier), F.lit(0))), "queue_starts"
    )
    totals = {r.source: r.tokens for r in starts.groupBy("source").agg(F.sum("tokens").alias("tokens")).collect()}
    schedule = Schedule(totals, targets, window)

    def rounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last, found = batch.column("last").to_numpy(), np.zeros(batch.num_rows, np.int64)
            of = np.array([schedule.index[s] for s in batch.column("source").to_pylist()], np.int64)
            for queue in np.unique(of):
                mine = of == queue
                found[mine] = schedule.round_of(schedule.sources[queue], last[mine])
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("row"), batch.column("tokens"), pa.array(found), pa.array(of)],
                names=["part", "row", "tokens", "round", "queue"])

    placed = tokens.join(
        starts.select(F.col("part").alias("p"), F.col("source").alias("s"), "first"),
        (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s")),
    ).select("part", "row", "source", "tokens", (F.col("first") + F.col("before") + F.col("tokens")).alias("last"))
    served = placed.mapInArrow(rounds, "part int, row long, tokens long, round long, queue long").withColumn(
        "run", F.floor(F.col("round") / ROUNDS))
    order = Window.partitionBy("run").orderBy("round", "queue", "part", "row").rowsBetween(Window.unboundedPreceding, -1)
    within = stage_table(served.select("part", "row", "run", "tokens", F.coalesce(F.sum("tokens").over(order), F.lit(0)).alias("within")), "order")
    stream = within.join(_run_starts(within), "run").select(
        F.col("part").alias("p"), F.col("row").alias("r"), (F.col("within") + F.col("start")).alias("place"))
    columns = ["doc_id", "tokens", "place", *["ids"] * with_ids]
    whole = tokens.join(stream, (F.col("part") == F.col("p")) & (F.col("row") == F.col("r"))).select(*columns)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _id_type(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                yield _cut(batch.slice(at, 1024), window, kind, with_ids)

    return whole.mapInArrow(cut, _PIECES)


def _run_starts(within: DataFrame, group: int = 4096) -> DataFrame:
    """run and the tokens before it: running totals within groups of runs, and over the few groups."""
    runs = within.groupBy("run").agg(F.sum("tokens").alias("tokens")).withColumn("group", F.floor(F.col("run") / group))
    before = lambda w: F.coalesce(F.sum("tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = runs.groupBy("group").agg(F.sum("tokens").alias("tokens"))
    groups = groups.select("group", before(Window.orderBy("group")).alias("earlier"))
    return runs.withColumn("start", before(Window.partitionBy("group").orderBy("run"))).join(groups, "group").select(
        "run", (F.col("start") + F.col("earlier")).alias("start"))


def _cut(batch: pa.RecordBatch, window: int, kind: np.dtype, with_ids: bool) -> pa.RecordBatch:
    """Pieces of documents where their places in the stream cross the end of a window."""
    counts, place = batch.column("tokens").to_numpy(), batch.column("place").to_numpy()
    first, stop = place // window, (place + counts - 1) // window + 1
    n = stop - first
    row = np.repeat(np.arange(len(n)), n)
    sequence = np.repeat(first - np.cumsum(n) + n, n) + np.arange(len(row))
    begin = np.maximum(place[row], sequence * window)
    length = np.minimum((place + counts)[row], (sequence + 1) * window) - begin
    start, offset = begin - place[row], begin - sequence * window
    if with_ids:
        whole = [np.frombuffer(x, kind).astype("<u4").tobytes() for x in batch.column("ids").to_pylist()]
        ids = [whole[r][4 * a:4 * (a + m)] for r, a, m in zip(row.tolist(), start.tolist(), length.tolist())]
    else:
        ids = [None] * len(row)
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id").take(pa.array(row)), *map(pa.array, (start, length, counts[row], sequence, offset)),
         pa.array(ids, pa.binary())],
        names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
    )


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """The packed windows: ``ids`` padded to ``window`` unless their number is a power of two."""
    grouped = pieces.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "start", "ids"))).alias("pieces")
    )
    ids = F.aggregate("pieces", F.lit(b"").cast("binary"), lambda all_, p: F.concat(all_, p["ids"]))
    used = F.aggregate("pieces", F.lit(0).cast("long"), lambda n, p: n + p["length"])
    full = F.when(F.pow(F.lit(2), F.floor(F.log2(used.cast("double")))) == used, used).otherwise(F.lit(window))
    one = pad_id.to_bytes(4, "little").hex()
    pad = F.unhex(F.repeat(F.lit(one), (full - used).cast("int")))
    return grouped.select("sequence_id", used.alias("used"), full.alias("length"),
                          F.concat(ids, pad).alias("ids"), "pieces")


def op3_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skyledger.llm.common import table
    from skyledger.llm.vocabulary import public_path

    return digest(pack(table(spark, sf_dir, "documents"), public_path("byte_bpe_50k.json")))


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")
