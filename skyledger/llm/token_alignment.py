"""Alignment of two tokenizers over a corpus, through inverted pair bitmaps.

Each text is encoded by a byte-level file (A) and a piece file (B). Offsets where tokens of both end cut
it into groups; the two tokens that end there are a link. Every id pair has an inverted list of the
documents that link it: a compressed bitmap over blocks of ``BLOCK`` numbered documents, as sorted
16-bit row numbers while few, as a bit field of 2048 bytes once that is smaller. How often a
document links a pair is written in binary: plane ``k`` is the bitmap of documents whose count has bit ``k``.

Tasks write partial bitmaps whenever they hold ``FLUSH`` links. Those of one block and pair are
OR-merged, then counted: the popcount of all planes OR-ed gives documents, popcounts times powers of two
give links. Sums per pair are small; the best count of each B id and the counts return along the
postings, which add them to the documents of their rows.

Document numbers are (partition, row), so ids may be null or repeated. A block's postings are
merged as a stream and never gathered; a pair in every document is one row a block and plane.

Defined cases: a null or empty text, or one whose tokens of A or B do not spell a space and the text,
has no tokens: zeros and an empty digest; repeated rows each count; an empty table gives an empty
result; special tokens inside a text are plain text; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import narrow, table
from skyledger.llm.encoders import byte_level, byte_level_tokens, piece_model, sizes
from skyledger.llm.vocabulary import public_path
from skyledger.session import stage_table

BLOCK = 1 << 14
FLUSH = 2_000_000
_FIELD = BLOCK // 8  # bytes of a bit field; a shorter bitmap is a list of 16-bit rows

_COUNTS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_PARTIAL = f"block long, row int, {_COUNTS}, pair long, plane int, bits binary"


def pack_rows(rows: np.ndarray) -> bytes:
    """A bitmap of sorted distinct rows below ``BLOCK``."""
    if 2 * len(rows) < _FIELD:
        return rows.astype("<u2").tobytes()
    field = np.zeros(BLOCK, np.uint8)
    field[rows] = 1
    return np.packbits(field, bitorder="little").tobytes()


def unpack_rows(bits: bytes) -> np.ndarray:
    if len(bits) < _FIELD:
        return np.frombuffer(bits, "<u2").astype(np.int64)
    return np.nonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))[0]


def popcount(bits: bytes) -> int:
    return len(bits) // 2 if len(bits) < _FIELD else int.from_bytes(bits, "little").bit_count()


def merged(some: list[bytes]) -> bytes:
    """The OR of bitmaps."""
    if len(some) == 1:
        return some[0]
    if all(len(bits) == _FIELD for bits in some):
        return np.bitwise_or.reduce([np.frombuffer(bits, np.uint8) for bits in some]).tobytes()
    return pack_rows(np.unique(np.concatenate([unpack_rows(bits) for bits in some])))


class Aligner:
    """Groups and links of texts. A pair is ``a * width + b``."""

    def __init__(self, a_path: str, b_path: str):
        self.encode = byte_level(a_path, specials=False)
        self.a_tokens = byte_level_tokens(a_path)
        self.model, self.b_tokens = piece_model(b_path)
        self.a_sizes, self.b_sizes = sizes(self.a_tokens), sizes(self.b_tokens)
        self.width = len(self.b_tokens)
        # A token's number followed by what may come after it: another of its kind, the other kind, a group.
        count = max(len(self.a_tokens), len(self.b_tokens))
        self.written = np.array([f"{at}{mark}" for at in range(count) for mark in ",|;"], dtype=object)

    def align(self, text: str | None):
        """(n_a, n_b, groups as text, pair of each link), or None without tokens."""
        if not text or "▁" in text:
            return None
        whole = " " + text
        a, b = self.encode(whole), self.model.encode(text)
        spelled = whole.encode()
        if b"".join(map(self.a_tokens.__getitem__, a)) != spelled or b"".join(map(self.b_tokens.__getitem__, b)) != spelled:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        near = np.searchsorted(b_ends, a_ends)
        a_last = np.nonzero(b_ends[near] == a_ends)[0]
        b_last = near[a_last]
        # Tokens by group, A before B: both are in order, so one stable sort by group and kind does.
        a_mark, b_mark = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        a_mark[a_last], b_mark[b_last] = 1, 2
        a_group, b_group = np.cumsum(a_mark > 0) - (a_mark > 0), np.cumsum(b_mark > 0) - (b_mark > 0)
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        written = self.written[np.concatenate([3 * a + a_mark, 3 * b + b_mark])[order]]
        return len(a), len(b), "".join(written.tolist())[:-1], a[a_last] * self.width + b[b_last]


def _postings(block: int, held: list[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Partial bitmaps of (row, pairs) of one block, by plane."""
    if not held:
        return
    rows = np.repeat([row for row, _ in held], [len(pairs) for _, pairs in held])
    keys, count = np.unique(np.concatenate([pairs for _, pairs in held]) * BLOCK + rows, return_counts=True)
    plane = 0
    while len(keys):
        some = keys[(count & 1) == 1]
        if len(some):
            pair, row = some // BLOCK, (some % BLOCK).astype("<u2")
            first = np.nonzero(np.diff(pair, prepend=pair[0] - 1))[0]
            bounds = np.append(first, len(some))
            lists = pa.Array.from_buffers(
                pa.binary(), len(first), [None, pa.py_buffer((2 * bounds).astype("<i4").tobytes()), pa.py_buffer(row.tobytes())])
            dense = np.nonzero(2 * np.diff(bounds) >= _FIELD)[0]
            if len(dense):
                values = lists.to_pylist()
                for at in dense:
                    values[at] = pack_rows(row[bounds[at]:bounds[at + 1]].astype(np.int64))
                lists = pa.array(values, pa.binary())
            for at in range(0, len(first), 1 << 16):
                part = pair[first[at:at + (1 << 16)]]
                yield _rows(len(part), block=np.full(len(part), block), pair=part,
                            plane=np.full(len(part), plane, np.int32), bits=lists.slice(at, 1 << 16))
        more = count > 1
        keys, count, plane = keys[more], count[more] >> 1, plane + 1


_TYPES = {"block": pa.int64(), "row": pa.int32(), "doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(),
          "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(), "pair": pa.int64(),
          "plane": pa.int32(), "bits": pa.binary()}


def _rows(n: int, **columns) -> pa.RecordBatch:
    arrays = [pa.array(columns[c], kind) if c in columns and not isinstance(columns[c], pa.Array) else
              columns.get(c, pa.nulls(n, kind)) for c, kind in _TYPES.items()]
    return pa.RecordBatch.from_arrays(arrays, names=list(_TYPES))


def encode_pairs(documents: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row a document (``pair`` null) and its partial postings, in one pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, aligner = TaskContext.get().partitionId(), Aligner(a_path, b_path)
        held, links, number = [], 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some, out = batch.slice(at, 256), []
                for text in some.column(1).to_pylist():
                    if number % BLOCK == 0 and held:
                        yield from _postings((part << 32) + number // BLOCK - 1, held)
                        held, links = [], 0
                    found = aligner.align(text)
                    if found is None:
                        out.append((0, 0, 0, ""))
                    else:
                        n_a, n_b, groups, pairs = found
                        out.append((n_a, n_b, len(pairs), hashlib.sha256(groups.encode()).hexdigest()))
                        held.append((number % BLOCK, pairs))
                        links += len(pairs)
                    number += 1
                    if links >= FLUSH:
                        yield from _postings((part << 32) + (number - 1) // BLOCK, held)
                        held, links = [], 0
                numbers = np.arange(number - len(out), number)
                n_a, n_b, groups, digest = zip(*out) if out else ([], [], [], [])
                yield _rows(len(out), block=(part << 32) + numbers // BLOCK, row=(numbers % BLOCK).astype(np.int32),
                            doc_id=some.column(0), n_a=n_a, n_b=n_b, n_groups=groups, n_links=groups, groups_sha256=digest)
        yield from _postings((part << 32) + (number - 1) // BLOCK, held)

    rows = narrow(documents, ["doc_id", "text"]).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, _PARTIAL)


def merge_postings(partial: DataFrame) -> DataFrame:
    """block, pair, planes (bitmaps, lowest bit first), documents and links of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, planes = None, []
        out = []

        def close():
            bitmaps = [merged(p) if p else b"" for p in planes]
            counts = [popcount(b) for b in bitmaps]
            any_of = counts[0] if len(bitmaps) == 1 else popcount(merged([b for b in bitmaps if b]))
            out.append((*key, bitmaps, any_of, sum(c << k for k, c in enumerate(counts))))

        def batch_of(rows):
            block, pair, planes_of, documents, links = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(block, pa.int64()), pa.array(pair, pa.int64()), pa.array(planes_of, pa.list_(pa.binary())),
                 pa.array(documents, pa.int64()), pa.array(links, pa.int64())],
                names=["block", "pair", "planes", "documents", "links"])

        for batch in batches:
            for block, pair, plane, bits in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if (block, pair) != key:
                    if key is not None:
                        close()
                    key, planes = (block, pair), []
                while len(planes) <= plane:
                    planes.append([])
                planes[plane].append(bits)
                if len(out) >= 4096:
                    yield batch_of(out)
                    out.clear()
        if key is not None:
            close()
            yield batch_of(out)

    return (
        partial.where("pair is not null").select("block", "pair", "plane", "bits")
        .repartition("block").sortWithinPartitions("block", "pair", "plane")
        .mapInArrow(run, "block long, pair long, planes array<binary>, documents long, links long")
    )


def pair_counts(postings: DataFrame, width: int) -> DataFrame:
    """pair, a_id, b_id, documents, links and whether no pair of the B id has more links."""
    counts = postings.groupBy("pair").agg(F.sum("documents").alias("documents"), F.sum("links").alias("links"))
    counts = stage_table(counts.select(
        "pair", F.floor(F.col("pair") / width).alias("a_id"), (F.col("pair") % width).alias("b_id"), "documents", "links"),
        "pair_counts")
    top = counts.groupBy("b_id").agg(F.max("links").alias("most"))
    return counts.join(top, "b_id").select("pair", "a_id", "b_id", "documents", "links", (F.col("links") == F.col("most")).alias("best"))


def return_scores(partial: DataFrame, postings: DataFrame, counts: DataFrame) -> DataFrame:
    """The documents with n_best and count_sum, added up from the postings of their block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total, best = None, np.zeros(BLOCK, np.int64), np.zeros(BLOCK, np.int64)
        for batch in batches:
            blocks, is_doc = batch.column("block").to_numpy(), batch.column("row").is_valid().to_numpy(zero_copy_only=False)
            cuts = np.nonzero(np.diff(blocks) | np.diff(is_doc.astype(int)))[0] + 1
            for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if a == z:
                    continue
                if blocks[a] != block:
                    block = blocks[a]
                    total[:], best[:] = 0, 0
                some = batch.slice(a, z - a)
                if is_doc[a]:
                    at = some.column("row").to_numpy()
                    yield pa.RecordBatch.from_arrays(
                        [*(some.column(c) for c in _DIGEST[:5]), pa.array(best[at]), pa.array(total[at]), some.column("groups_sha256")],
                        names=[*_DIGEST[:5], "n_best", "count_sum", "groups_sha256"])
                else:
                    _add(some, total, best)

    scored = postings.select("block", "pair", "planes").join(counts.select("pair", "links", "best").hint("merge"), "pair")
    docs = partial.where("pair is null").select("block", "row", *_DIGEST)
    rows = docs.unionByName(scored.drop("pair"), allowMissingColumns=True)
    return rows.repartition("block").sortWithinPartitions(F.col("block"), F.col("row").asc_nulls_first()).mapInArrow(
        run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


_DIGEST = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def _add(some: pa.RecordBatch, total: np.ndarray, best: np.ndarray) -> None:
    """Add the scores of postings to the documents of their rows."""
    lists, links = some.column("planes"), some.column("links").to_numpy()
    top = some.column("best").to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy()
    planes = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    at = np.repeat(np.arange(len(links)), np.diff(offsets))
    weight = np.left_shift(1, np.arange(len(at)) - (offsets[:-1] - offsets[0])[at])
    size = np.diff(np.frombuffer(planes.buffers()[1], "<i4", count=len(planes) + 1, offset=4 * planes.offset))
    values = planes.to_pylist()
    lists_at = np.nonzero(size < _FIELD)[0]
    rows = np.frombuffer(b"".join([values[i] for i in lists_at]), "<u2")
    which = np.repeat(lists_at, size[lists_at] // 2)
    np.add.at(total, rows, (links[at] * weight)[which])
    np.add.at(best, rows, (top[at] * weight)[which])
    for i in np.nonzero(size >= _FIELD)[0]:
        found = unpack_rows(values[i])
        total[found] += links[at[i]] * weight[i]
        best[found] += top[at[i]] * weight[i]


def align_tokens(documents: DataFrame, a_path: str, b_path: str) -> tuple[DataFrame, DataFrame]:
    """(one row a document, one row a linked id pair)."""
    partial = stage_table(encode_pairs(documents, a_path, b_path), "partial_postings")
    postings = stage_table(merge_postings(partial), "postings")
    counts = stage_table(pair_counts(postings, piece_model(b_path)[0].vocab_size()), "scored_pairs")
    return return_scores(partial, postings, counts), counts


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return align_tokens(documents, public_path("byte_bpe_50k.json"), public_path("piece_bpe_32k.model"))[0]
