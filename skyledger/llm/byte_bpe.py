"""Byte-level BPE by segment trees.

A piece of text (a match of the pre-tokenizing pattern) starts as its bytes. The leaves of
a segment tree are the byte positions; a leaf holds the rank of the pair that starts there, and
an inner node the smallest (rank, position) below it, so the root names the leftmost pair of
minimum rank. A merge touches three leaves (the pair, its right part, its live left
neighbour), and each of them is one path to the root: ``log2`` updates instead of a scan.

Short pieces are encoded many at a time, one tree a row of an array; long ones, a whole text
without a space for instance, one at a time with the same tree in a list.

Defined cases: a null text counts as empty and has no ids; texts are taken whole, however long;
repeated rows are encoded like any other; an empty table gives an empty result; a column
of the input that is called like a result column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.chunks import PieceCache
from skyledger.llm.vocabulary import public_path, ranks

#: Pieces up to so many bytes are encoded together.
TOGETHER = 64
_NONE = np.int64(1) << 62


class PairRanks:
    """The rank of the token that two neighbours make, if there is one."""

    def __init__(self, vocabulary: dict[bytes, int]):
        found = {}
        for token, rank in vocabulary.items():
            for cut in range(1, len(token)):
                left, right = vocabulary.get(token[:cut]), vocabulary.get(token[cut:])
                if left is not None and right is not None:
                    found[left << 32 | right] = rank
        self.by_pair = found
        self.keys = np.array(sorted(found), dtype=np.int64)
        self.values = np.array([found[k] for k in self.keys.tolist()], dtype=np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; ``_NONE`` where the pair makes no token or a side is missing (-1)."""
        if not len(self.keys):
            return np.full(len(left), _NONE)
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.values[at], _NONE)


class ByteBpe:
    """Encodes pieces with the ranks of a vocabulary."""

    def __init__(self, vocabulary: dict[bytes, int], pattern: str):
        import regex

        self.vocabulary = vocabulary
        self.pattern = regex.compile(pattern)
        self.pairs = PairRanks(vocabulary)
        self.byte_ids = np.array([vocabulary[bytes([b])] for b in range(256)], dtype=np.int64)
        self.tokens = {rank: token for token, rank in vocabulary.items()}
        self._known: dict[str, bytes] = {}
        self.cache = PieceCache(self._encode_chunks)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        return [b"".join(found) for found in self.cache.lookup(texts)]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        matches = [self.pattern.findall(chunk) for chunk in chunks]
        known = self._known
        if len(known) > 400_000:
            known.clear()
        new = list({match for one in matches for match in one if match not in known})
        known.update(zip(new, self.encode_pieces([match.encode() for match in new])))
        found = [b"".join(map(known.__getitem__, one)) for one in matches]
        for match in new:
            if len(match) > TOGETHER:
                del known[match]
        return found

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Each piece on its own; a piece that is a token is that token."""
        out: list[bytes | None] = [None] * len(pieces)
        groups: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            rank = self.vocabulary.get(piece)
            if rank is not None:
                out[i] = rank.to_bytes(4, "little")
            elif not piece:
                out[i] = b""
            elif len(piece) > TOGETHER:
                out[i] = np.array(self._merge_one(piece), dtype="<u4").tobytes()
            else:
                groups.setdefault(1 << (len(piece) - 1).bit_length(), []).append(i)
        for width, rows in groups.items():
            for at in range(0, len(rows), 1 << 14):
                some = rows[at:at + (1 << 14)]
                for i, ids in zip(some, self._merge_many([pieces[i] for i in some], width)):
                    out[i] = ids
        return out

    def _merge_many(self, pieces: list[bytes], width: int) -> list[bytes]:
        """One segment tree of ``width`` leaves a row; node 1 is the root, leaf i is ``width + i``."""
        n, bits = len(pieces), width.bit_length()
        lengths = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
        spot = np.arange(width)
        ids = np.where(spot < lengths[:, None], self.byte_ids[raw], -1)
        after = np.where(spot + 1 < lengths[:, None], spot + 1, width) + np.zeros((n, 1), np.int64)
        before = np.broadcast_to(spot - 1, (n, width)).copy()
        right = np.concatenate([ids[:, 1:], np.full((n, 1), -1)], axis=1)
        tree = np.full((n, 2 * width), _NONE)
        rank = self.pairs.of(ids.ravel(), right.ravel()).reshape(n, width)
        tree[:, width:] = np.where(rank < _NONE, rank << bits | spot, _NONE)
        level = width
        while level > 1:
            level >>= 1
            tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2])
        rows = np.nonzero(tree[:, 1] < _NONE)[0]
        while len(rows):
            at = tree[rows, 1] & ((1 << bits) - 1)
            gone = after[rows, at]
            ids[rows, at] = tree[rows, 1] >> bits
            ids[rows, gone] = -1
            nxt = after[rows, gone]
            after[rows, at] = nxt
            has = nxt < width
            before[rows[has], nxt[has]] = at[has]
            prev = before[rows, at]
            next_id = np.where(has, ids[rows, np.minimum(nxt, width - 1)], -1)
            prev_id = np.where(prev >= 0, ids[rows, np.maximum(prev, 0)], -1)
            self._set(tree, rows, gone, np.full(len(rows), _NONE), width)
            rank = self.pairs.of(ids[rows, at], next_id)
            self._set(tree, rows, at, np.where(rank < _NONE, rank << bits | at, _NONE), width)
            had = np.nonzero(prev >= 0)[0]
            rank = self.pairs.of(prev_id[had], ids[rows, at][had])
            self._set(tree, rows[had], prev[had], np.where(rank < _NONE, rank << bits | prev[had], _NONE), width)
            rows = rows[tree[rows, 1] < _NONE]
        alive = ids >= 0
        flat = ids[alive].astype("<u4").tobytes()
        ends = np.cumsum(alive.sum(axis=1)) * 4
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    @staticmethod
    def _set(tree: np.ndarray, rows: np.ndarray, leaf: np.ndarray, value: np.ndarray, width: int) -> None:
        """Point updates, one leaf a row, and the nodes above."""
        node = leaf + width
        tree[rows, node] = value
        while width > 1:
            node, width = node >> 1, width >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    def _merge_one(self, piece: bytes) -> list[int]:
        """The same for one long piece, with plain lists."""
        n = len(piece)
        width = 1 << (n - 1).bit_length()
        bits, none, by_pair = width.bit_length(), int(_NONE), self.pairs.by_pair
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        tree = [none] * (2 * width)
        for i in range(n - 1):
            rank = by_pair.get(ids[i] << 32 | ids[i + 1])
            if rank is not None:
                tree[width + i] = rank << bits | i
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(leaf: int, left: int, right: int) -> None:
            rank = by_pair.get(ids[left] << 32 | ids[right]) if left >= 0 and right >= 0 else None
            node = leaf + width
            tree[node] = none if rank is None else rank << bits | leaf
            while node > 1:
                node >>= 1
                least = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == least:
                    return
                tree[node] = least

        mask = (1 << bits) - 1
        while tree[1] < none:
            at = tree[1] & mask
            gone = after[at]
            ids[at], ids[gone] = tree[1] >> bits, -1
            after[at] = nxt = after[gone]
            if nxt >= 0:
                before[nxt] = at
            put(gone, -1, -1)
            put(at, at, nxt)
            if before[at] >= 0:
                put(before[at], before[at], at)
        return [one for one in ids if one >= 0]


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> ByteBpe:
    """One a worker process: tables and known pieces stay for its next tasks."""
    return ByteBpe(ranks(path), pattern)


def encode(df: DataFrame, path: str, pattern: str, *, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the ids of ``text`` as little-endian unsigned 32-bit integers."""
    kept = [name for name in df.columns if name not in (ids, "n_tokens")]
    schema = df.select(*[F.col(f"`{c}`") for c in kept]).schema.add(ids, "binary").add("n_tokens", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                found = own.encode(some.column(kept.index(text)).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array(found, pa.binary()), pa.array([len(x) // 4 for x in found], pa.int64())],
                    names=schema.names,
                )

    return df.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)


def decode(df: DataFrame, path: str, pattern: str, *, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds the bytes that ``ids`` stand for; null ids give none."""
    kept = [name for name in df.columns if name != decoded]
    schema = df.select(*[F.col(f"`{c}`") for c in kept]).schema.add(decoded, "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                found = [own.decode(x or b"") for x in some.column(kept.index(ids)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(found, pa.binary())], names=schema.names)

    return df.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from skyledger.llm.common import table

    path, pattern = public_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    coded = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, pattern).drop("text")
    return decode(coded, path, pattern).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
