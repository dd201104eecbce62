"""Toxicity scores from the nearest labelled examples.

Terms are words and word beginnings. All terms of a bounded sample of labelled documents
(``EXAMPLES`` a class, chosen by a hash of the id) are indexed, with document frequencies among these
examples. Each text becomes a TF-IDF vector of all these terms; its ``NEIGHBOURS`` nearest
examples by cosine are found exactly.

The index is block-max: examples are ordered so that like ones lie together and cut into blocks of
``BLOCK``. Terms of few examples have posting lists, one for each count in an example, all of which are
added up. A term of many examples has its list as a dense row, with the largest weight in each block. A block whose bound (the largest
sum so far in it, plus the query's weights times the block's largest ones) is below the k-th best score
of the most promising blocks is not visited. All examples as near as the k-th count, so ties do not matter.

Neighbours vote with their similarity, in which each shared term counts by the square of how far apart its
shares of toxic and of other examples are (the logarithm of their ratio; below ``LEAST_APART`` it
does not vote), and each class by its share of all training labels. A logistic curve, fitted on votes of
the examples without themselves, turns votes into scores. The nearest examples are returned as evidence.

The model is as large as the examples and their terms, whatever the corpus, and is broadcast once.
Defined cases: a null or empty text, or one without a known term, is nearest to the examples
without any; without examples of both classes the score is the share of toxic labels (0 without
labels) and there is no evidence; labels that are null, or name no document, teach nothing; of
several labels of a document the largest counts; repeated rows are scored like any other; an
empty table gives an empty result; columns of the input called like a result column are replaced.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from skyledger.llm.common import table, top_by
from skyledger.session import stage_table

EXAMPLES = 3000
NEIGHBOURS = 200
BLOCK = 128
#: Texts searched at once; their sums over all examples stay in a few megabytes.
QUERIES = 128
#: Terms of texts whose lists are looked up at once; a text of more is looked up by itself.
TERMS = 1 << 15
#: Numbers kept for ranges.
NUMBERS = 1 << 16
#: Characters of short texts hashed at once; a longer text is hashed by itself.
STRETCH = 1 << 16
#: Terms of a vocabulary hashed at once.
HASHED_AT_ONCE = 4096
#: A term of more than this share of the examples has a dense row.
DENSE = 0.1
#: Logarithms of class ratios nearer to 0 than this say nothing.
LEAST_APART = 0.5
#: The weight of the average mix in each vote.
SMOOTHING = 0.01
_BEGINNINGS = (4, 5, 6)
_WORD = re.compile(r"[^\W\d_]+")
_BASE = 0x9E3779B97F4A7C15
_BEGINS = np.uint64(0xD6E8FEB86659FD93)
_EVIDENCE = "array<struct<doc_id:long,similarity:double,toxic:double>>"


def terms_of(chunk: str) -> list[str]:
    """Words of a stretch of text without white space, and how they begin."""
    out = []
    for word in _WORD.findall(chunk.lower()):
        out.append(word)
        out += {"^" + word[:n] for n in _BEGINNINGS if len(word) >= n - 1}
    return out


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points words are made of: those of ``_WORD``."""
    is_letter = np.zeros(0x110000 + 1, bool)
    is_letter[[c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and _WORD.match(chr(c))]] = True
    return is_letter


@lru_cache(maxsize=4)  # long and short texts alternate
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    base = np.full(size, _BASE, np.uint64)
    other = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
    base[0] = other[0] = 1
    return np.multiply.accumulate(base), np.multiply.accumulate(other)


def _word_hashes(text: str) -> tuple[np.ndarray, np.ndarray, Callable[[np.ndarray, np.ndarray], np.ndarray]]:
    """(start, length) of the words of a lower-case text, and a function that hashes so many characters from a
    start on: differences of one running polynomial, shifted to the start."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    inside = np.zeros(len(points) + 2, np.int8)
    inside[1:-1] = _letters()[points]
    edges = np.diff(inside)
    start, stop = np.nonzero(edges > 0)[0], np.nonzero(edges < 0)[0]
    powers, inverse = _powers(1 << max(16, int(len(points)).bit_length()))
    total = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * powers[:len(points)], out=total[1:])

    def of(first: np.ndarray, length: np.ndarray) -> np.ndarray:
        h = (total[first + length] - total[first]) * inverse[first]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))

    return start, stop - start, of


def term_hashes(terms: Sequence[str] | pa.ChunkedArray) -> np.ndarray:
    """The hashes of terms: words, or ``^`` and a beginning. Some thousand at a time: the sums and powers of a
    stretch take thirty times its characters."""
    plain = lambda part: part.to_pylist() if isinstance(part, pa.ChunkedArray) else part
    some = [_term_hashes(plain(terms[at:at + HASHED_AT_ONCE])) for at in range(0, len(terms), HASHED_AT_ONCE)]
    return np.concatenate([np.zeros(0, np.uint64), *some])


def _term_hashes(terms: Sequence[str]) -> np.ndarray:
    begins = np.fromiter((t.startswith("^") for t in terms), bool, len(terms))
    start, length, of = _word_hashes(" ".join(terms).lower())
    if len(start) != len(terms):
        raise ValueError("a term is one word")
    return np.where(begins, of(start, length) ^ _BEGINS, of(start, length))


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


class TermCounter:
    """Counts vocabulary terms of whole texts. The vocabulary is held as 64-bit hashes, a tenth of what its
    strings take; among a million terms a clash has odds of one in 10^7."""

    def __init__(self, vocabulary: Sequence[str] | np.ndarray):
        hashes = vocabulary if isinstance(vocabulary, np.ndarray) else term_hashes(vocabulary)
        order = np.argsort(hashes, kind="stable").astype(np.int32)
        self._size = len(order)
        # A last place that is no term's: every search ends there at the latest.
        self._order = np.append(order, np.int32(-1))
        self._sorted = np.append(hashes[order], np.uint64(2 ** 64 - 1))
        #: Hashes spread evenly, so the terms from a hash's first bits on begin next to its place.
        bits = max(1, self._size.bit_length())
        self._shift = np.uint64(64 - bits)
        self._start = np.searchsorted(self._sorted[:-1] >> self._shift, np.arange(1 << bits, dtype=np.uint64)).astype(np.int32)
        self._begins = np.full((max(1, len(hashes)), len(_BEGINNINGS)), -1, np.int32)
        self._met = np.zeros(max(1, len(hashes)), bool)

    def vectors(self, texts: Sequence[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(terms, counts) of each text, terms in order. Short texts are counted together."""
        out, some, size = [], [], 0
        for text in texts:
            text = (text or "").lower()
            if some and size + len(text) >= STRETCH:
                out += self._together(some)
                some, size = [], 0
            some.append(text)
            size += len(text) + 1
        return out + self._together(some) if some else out

    def _together(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The vectors of lower-case texts. The beginnings of a known word are looked up when it is first met."""
        start, length, of = _word_hashes(" ".join(texts))
        words = self._places(of(start, length))
        new = np.nonzero((words >= 0) & ~self._met[words])[0]
        if len(new):
            self._begins[words[new]] = self._beginnings(start[new], length[new], of)
            self._met[words[new]] = True
        terms = np.empty((1 + len(_BEGINNINGS), len(words)), np.int32)
        terms[0] = words
        terms[1:] = self._begins[words].T
        strange = np.nonzero(words < 0)[0]
        terms[1:, strange] = self._beginnings(start[strange], length[strange], of).T
        ends = np.cumsum([len(t) + 1 for t in texts])
        document = np.searchsorted(start, ends)
        document = np.repeat(np.arange(len(texts)) * self._size, np.diff(document, prepend=0))
        keys = (terms + document)[terms >= 0]
        keys, counts = np.unique(keys, return_counts=True)
        bounds = np.searchsorted(keys, np.arange(len(texts) + 1) * self._size)
        return [(keys[a:b] - i * self._size, counts[a:b]) for i, (a, b) in enumerate(zip(bounds, bounds[1:]))]

    def _beginnings(self, start: np.ndarray, length: np.ndarray, of: Callable) -> np.ndarray:
        """The terms of the beginnings of words, -1 for those a word has not or that are unknown."""
        terms = np.full((len(start), len(_BEGINNINGS)), -1, np.int32)
        for i, n in enumerate(_BEGINNINGS):
            # A beginning as long as the one before is the same term of the word.
            some = np.nonzero(length >= (n if i else n - 1))[0]
            terms[some, i] = self._places(of(start[some], np.minimum(length[some], n)) ^ _BEGINS)
        return terms

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        """The terms of hashes, -1 for unknown ones."""
        at = self._start.take(hashes >> self._shift)
        there = self._sorted.take(at)
        less = np.nonzero(there < hashes)[0]
        while len(less):
            at[less] += 1
            there[less] = self._sorted.take(at[less])
            less = less[there[less] < hashes[less]]
        return np.where(there == hashes, self._order.take(at), np.int32(-1))

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(terms, counts) of a text, terms in order."""
        return self.vectors([text])[0]

    def counts(self, text: str | None) -> dict[int, int]:
        return dict(zip(*(x.tolist() for x in self.vector(text))))


def term_vectors(documents: DataFrame, vocabulary: Sequence[str] | np.ndarray) -> DataFrame:
    """doc_id and the counts of vocabulary terms (or terms of these hashes) of each whole text."""
    hashes = vocabulary if isinstance(vocabulary, np.ndarray) else term_hashes(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TermCounter(hashes)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                found = counter.vectors(some.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array([t for t, _ in found], pa.list_(pa.int32())),
                     pa.array([c for _, c in found], pa.list_(pa.int32()))],
                    names=["doc_id", "terms", "counts"],
                )

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, terms array<int>, counts array<int>")


def example_terms(examples: DataFrame) -> tuple[pa.ChunkedArray, np.ndarray, np.ndarray]:
    """All terms of the examples, in order, and how many toxic and other ones have each; ``examples``
    has text and toxic. The terms stay in Arrow: as Python strings they take several times as much."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                chunks = set((text or "").split())
                seen[1 if toxic else 0].update({t for chunk in chunks for t in terms_of(chunk)})
        terms = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), pa.array([seen[1][t] for t in terms], pa.int64()),
             pa.array([seen[0][t] for t in terms], pa.int64())], names=["term", "toxic", "clean"],
        )

    sums = examples.select("text", "toxic").mapInArrow(run, "term string, toxic long, clean long").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).toArrow().sort_by("term")
    return sums.column("term"), sums.column("toxic").to_numpy(), sums.column("clean").to_numpy()


class Examples:
    """A block-max inverted index of weighted vectors with votes. Examples with the same vector are one entry."""

    def __init__(self, idf: np.ndarray, vectors: list[tuple], weight: tuple[float, float], k: int = NEIGHBOURS,
                 steer: np.ndarray | None = None):
        """``idf``: the weight of each term; ``vectors``: (doc_id, terms, counts, toxic); ``steer``: how much
        each term counts in a vote, all alike if it is None."""
        self.idf, self.weight, self.k = idf, weight, k
        self.steer = np.ones(len(idf)) if steer is None else steer
        entries: dict[bytes, list] = {}
        self.empty = (0.0, 0.0, [])
        for doc_id, terms, counts, toxic in vectors:
            entry = entries.setdefault(_key(terms, counts), [0, 0, [], terms, counts])
            entry[1 if toxic else 0] += 1
            entry[2] = sorted([*entry[2], doc_id])[:3]
        kept = []
        for entry in entries.values():
            if len(entry[3]):
                kept.append(entry)
            else:
                self.empty = (float(entry[0]), float(entry[1]), entry[2])
        seen = np.bincount(np.concatenate([np.asarray(e[3], np.int32) for e in kept] or [np.zeros(0, np.int32)]), minlength=len(idf))
        #: The terms of many examples.
        self.often = np.nonzero(seen > DENSE * len(kept))[0]
        del seen
        kept = [kept[i] for i in self._order(kept)]
        self.ids = [e[2] for e in kept]
        self.totals = np.array([e[:2] for e in kept], np.int64).reshape(-1, 2)
        self._list(kept)
        self._pad()

    #: All that is shipped; who searches builds the dense rows from it.
    _SHIPPED = ("idf", "weight", "k", "steer", "empty", "often", "ids", "totals", "scale", "entry", "start", "count", "first",
                "held")

    def __getstate__(self):
        return {name: self.__dict__[name] for name in self._SHIPPED}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._pad()

    def _list(self, kept: list) -> None:
        """The lists of terms of few examples, ordered by term and count: ``entry`` from ``start[i]`` on are the
        entries of list i, in which the term occurs ``count[i]`` times; a term's lists begin at ``first``.
        ``held`` has (row, entry, count) of the terms of many examples."""
        sizes = [len(e[3]) for e in kept]
        flat = lambda at: np.concatenate([np.asarray(e[at], np.int32) for e in kept] or [np.zeros(0, np.int32)])
        terms, counts = flat(3), flat(4)
        counts = counts.astype(np.min_scalar_type(int(counts.max(initial=1))))
        entry = np.repeat(np.arange(len(kept), dtype=np.min_scalar_type(max(1, len(kept)))), sizes)
        self.scale = np.array([1 / math.sqrt(float(w @ w)) for w in (self._unscaled(e[3], e[4]) for e in kept)])
        row = np.full(len(self.idf), -1, np.int32)
        row[self.often] = np.arange(len(self.often))
        row = row[terms]
        held = row >= 0
        self.held = row[held].astype(np.min_scalar_type(max(1, len(self.often)))), entry[held], counts[held]
        rare = np.nonzero(row < 0)[0]
        del row, held
        terms, counts, entry = terms[rare], counts[rare], entry[rare]
        order = np.lexsort((counts, terms))
        terms, counts, self.entry = terms[order], counts[order], entry[order]
        new = np.ones(len(terms), bool)
        new[1:] = (terms[1:] != terms[:-1]) | (counts[1:] != counts[:-1])
        new = np.nonzero(new)[0]
        self.start, self.count = np.append(new, len(terms)).astype(np.int32), counts[new]
        self.first = np.searchsorted(terms[new], np.arange(len(self.idf) + 1)).astype(np.int32)

    def _pad(self) -> None:
        """Fill the last block with entries that stand for no example."""
        self.size = -(-len(self.totals) // BLOCK) * BLOCK
        none = np.zeros(self.size - len(self.totals), np.int64)
        self.clean, self.toxic = (np.append(self.totals[:, i], none).astype(float) for i in (0, 1))

    def _build(self) -> None:
        """Dense rows, cut into blocks, and block maxima of the terms of many examples."""
        self.row = np.full(len(self.idf), -1, np.int16 if len(self.often) < 1 << 15 else np.int32)
        self.row[self.often] = np.arange(len(self.often))
        row, entry, count = self.held
        self.dense = np.zeros((self.size // BLOCK, len(self.often), BLOCK))
        value = (1 + np.log(np.arange(1, int(count.max(initial=1)) + 1)))[count - 1]
        value *= self.idf[self.often].take(row)
        value *= self.scale.take(entry)
        self.dense[entry // BLOCK, row, entry % BLOCK] = value
        self.most = self.dense.max(2).T
        self.length = np.diff(self.start)
        #: What an occurrence of a list's term weighs, before it is scaled by the entry.
        self.worth = np.repeat(self.idf, np.diff(self.first)) * (1 + np.log(self.count.astype(float)))
        self.factor = np.append(self.scale, np.zeros(self.size - len(self.scale)))
        self.voting = np.nonzero(self.steer[self.often] > 0)[0]
        self.voted = np.swapaxes(self.dense[:, self.voting], 0, 1).reshape(len(self.voting), self.size)

    def _order(self, kept: list) -> list[int]:
        """Entries with like weights of frequent terms next to each other, long ones after short ones."""
        if not len(self.often) or len(kept) <= BLOCK:
            return list(range(len(kept)))
        points, row = np.zeros((len(kept), len(self.often))), np.full(len(self.idf), -1)
        row[self.often] = np.arange(len(self.often))
        for i, e in enumerate(kept):
            at = row[np.asarray(e[3], np.int64)]
            points[i, at[at >= 0]] = self.weights(e[3], e[4])[at >= 0]
        points -= points.mean(0)
        axes = np.linalg.eigh(points.T @ points)[1][:, -3:]
        side = points @ axes > 0
        sizes = np.array([len(e[3]) for e in kept])
        return np.lexsort((sizes, *side.T)).tolist()

    def _unscaled(self, terms, counts) -> np.ndarray:
        return (1 + np.log(np.asarray(counts, float))) * self.idf[np.asarray(terms, int)]

    def weights(self, terms, counts) -> np.ndarray:
        w = self._unscaled(terms, counts)
        return w / math.sqrt(float(w @ w))

    def _few(self, terms: np.ndarray, weights: np.ndarray, query: np.ndarray, scores: np.ndarray, votes: np.ndarray) -> None:
        """Write what the lists of some terms, each of a query, add to the score and to the vote of each entry."""
        n = len(scores)
        order = np.argsort(2 * query + (self.steer[terms] == 0), kind="stable")  # those that vote come first
        terms, weights, query = terms[order], weights[order], query[order]
        steer = self.steer[terms]
        begin, end = self.first[terms], self.first[terms + 1]
        lists, count = _ranges(begin, end), end - begin
        length = self.length.take(lists)
        weight = np.repeat(weights, count)
        weight *= self.worth.take(lists)
        begin, end = self.start.take(begin), self.start.take(end)  # a term's lists follow one another
        bounds = np.searchsorted(query, np.arange(n + 1))
        voting = bounds[:-1] + np.bincount(query[steer > 0], minlength=n)
        ends = np.append(0, np.cumsum(count))
        steer = np.repeat(steer, count)
        for i, (a, b, v) in enumerate(zip(bounds.tolist(), bounds[1:].tolist(), voting.tolist())):
            entry = self.entry.take(_ranges(begin[a:b], end[a:b]), mode="clip")
            of, vote = slice(ends[a], ends[b]), slice(ends[a], ends[v])
            scores[i] = np.bincount(entry, np.repeat(weight[of], length[of]), minlength=self.size)
            vote = np.repeat(weight[vote] * steer[vote], length[vote])
            votes[i] = np.bincount(entry[:len(vote)], vote, minlength=self.size)
        scores *= self.factor
        votes *= self.factor

    def search(self, queries: list[tuple]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(entries, similarities, vote weights) of each query's (terms, counts), none of them empty, best
        first: all entries at least as near as the one after the k-th."""
        if "voting" not in self.__dict__:
            self._build()
        n, blocks = len(queries), self.size // BLOCK
        scores, votes, dense = np.empty((n, self.size)), np.empty((n, self.size)), np.zeros((n, len(self.often)))
        for a, b in _stretches([len(terms) for terms, _ in queries], TERMS):
            sizes = [len(terms) for terms, _ in queries[a:b]]
            terms = np.concatenate([np.asarray(terms, np.int64) for terms, _ in queries[a:b]])
            w = self._unscaled(terms, np.concatenate([counts for _, counts in queries[a:b]]))
            ends = np.cumsum(sizes).tolist()
            w /= np.repeat([math.sqrt(float(w[e - size:e] @ w[e - size:e])) for size, e in zip(sizes, ends)], sizes)
            query, row = np.repeat(np.arange(b - a), sizes), self.row.take(terms)
            often = row >= 0
            dense[a:b][query[often], row[often]] = w[often]
            self._few(terms[~often], w[~often], query[~often], scores[a:b], votes[a:b])
        wanted = min(blocks, -(-2 * (self.k + 1) // BLOCK))
        cube = scores.reshape(n, blocks, BLOCK)
        bound = cube.max(2) + dense @ self.most
        best = np.argpartition(-bound, wanted - 1, axis=1)[:, :wanted]
        visit = np.zeros((n, blocks), bool)
        np.put_along_axis(visit, best, True, axis=1)
        self._visit(cube, dense, visit)
        known = np.take_along_axis(cube, best[:, :, None], axis=1).reshape(n, wanted * BLOCK)
        least = np.partition(known, -self.k - 1, axis=1)[:, -self.k - 1] if known.shape[1] > self.k else np.zeros(n)
        more = ~visit & (bound >= least[:, None] - 1e-9)
        self._visit(cube, dense, more)
        cube[~(visit | more)] = 0.0
        votes += (dense[:, self.voting] * self.steer[self.often[self.voting]]) @ self.voted
        found = []
        for i in range(n):
            # At least as near as the one after the k-th of the most promising blocks, then as that of all.
            near = np.nonzero(scores[i] >= max(least[i] - 1e-9, 1e-12))[0]
            score = scores[i, near]
            if len(near) > self.k:
                some = score >= np.partition(score, -self.k - 1)[-self.k - 1] - 1e-9
                near, score = near[some], score[some]
            score = np.round(score, 12)
            order = np.argsort(-score, kind="stable")
            found.append((near[order], score[order], votes[i, near[order]]))
        return found

    def _visit(self, cube: np.ndarray, dense: np.ndarray, visit: np.ndarray) -> None:
        """Add the weights of frequent terms to the scores of the marked (query, block) pairs."""
        for b in np.nonzero(visit.any(0))[0]:
            some = np.nonzero(visit[:, b])[0]
            cube[some, b] += dense[some] @ self.dense[b]

    def _cut(self, found: tuple, without: int | None) -> tuple:
        """``found`` up to the last example as near as the k-th; ``without`` leaves out one example of the
        given label that has this very vector."""
        near, score, vote = found
        count = self.clean[near] + self.toxic[near]
        if without is not None:
            count = count - (np.cumsum(score > 1 - 1e-9) == 1) * (score > 1 - 1e-9)
        last = np.searchsorted(np.cumsum(count), self.k)
        keep = score >= score[last] if last < len(score) else np.ones(len(score), bool)
        return near[keep], score[keep], vote[keep]

    def nearest(self, terms, counts, without: int | None = None) -> list[tuple[float, int]]:
        """(similarity, entry) of all examples at least as near as the k-th."""
        near, score, _ = self._cut(self.search([(terms, counts)])[0], without)
        return list(zip(score.tolist(), near.tolist()))

    def share(self, found: tuple | None, without: int | None = None) -> float:
        """The toxic share of the votes of ``found``; None: of the examples without a term."""
        off = (without == 0, without == 1)
        if found is None:
            clean, toxic = self.empty[0] - off[0], self.empty[1] - off[1]
        else:
            near, score, vote = self._cut(found, without)
            clean, toxic = self.clean[near], self.toxic[near]
            same = np.nonzero(score > 1 - 1e-9)[0][:1]
            if len(same) and without is not None:
                clean[same] -= off[0]
                toxic[same] -= off[1]
            clean, toxic = float(vote @ np.maximum(clean, 0)), float(vote @ np.maximum(toxic, 0))
        clean, toxic = max(0.0, clean) * self.weight[0], max(0.0, toxic) * self.weight[1]
        return (toxic + SMOOTHING * self.prior) / (clean + toxic + SMOOTHING)

    @property
    def prior(self) -> float:
        clean = (self.clean.sum() + self.empty[0]) * self.weight[0]
        toxic = (self.toxic.sum() + self.empty[1]) * self.weight[1]
        return toxic / (clean + toxic) if clean + toxic else 0.0

    def evidence(self, found: tuple | None, most: int = 3) -> list[tuple[int, float, float]]:
        """(doc_id, similarity, toxic share of the examples with that vector) of the nearest."""
        if found is None:
            return []
        return [(self.ids[e][0], float(score), float(self.toxic[e] / (self.toxic[e] + self.clean[e])))
                for e, score in zip(found[0][:most].tolist(), found[1])]


def _ranges(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The numbers from each begin up to its end, one range after another."""
    count = (end - begin).astype(np.int64)
    ends = np.cumsum(count)
    numbers = np.repeat(begin - ends + count, count)
    numbers += _numbers()[:len(numbers)] if len(numbers) <= NUMBERS else np.arange(len(numbers))
    return numbers


@lru_cache(maxsize=1)
def _numbers() -> np.ndarray:
    return np.arange(NUMBERS)


def _stretches(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of things next to each other of at most that size together, or of one thing."""
    first = total = 0
    for i, size in enumerate(sizes):
        if i > first and total + size > most:
            yield first, i
            first, total = i, 0
        total += size
    if sizes:
        yield first, len(sizes)


def _key(terms, counts) -> bytes:
    """Equal for equal vectors."""
    return hashlib.blake2b(np.asarray(terms, np.int64).tobytes() + np.asarray(counts, np.int64).tobytes(),
                           digest_size=16).digest()


class ToxicityModel:
    """Vocabulary, index and calibration."""

    def __init__(self, terms: pa.ChunkedArray, hashes: np.ndarray, examples: Examples | None, share: float, curve=(1.0, 0.0)):
        self._terms, self.hashes, self.examples, self.share, self.curve = terms, hashes, examples, share, curve
        self._known: dict[bytes, tuple] = {}
        self._counter: TermCounter | None = None
        self._shared = None

    def __getstate__(self):
        return {**self.__dict__, "_terms": None, "_known": {}, "_counter": None, "_shared": None}

    @property
    def vocabulary(self) -> list[str]:
        """The terms; a broadcast model has their hashes only."""
        return self._terms.to_pylist()

    def shared(self, spark: SparkSession):
        """The model as one broadcast, made once: it does not ship the curve, which may come later."""
        if self._shared is None:
            self._shared = spark.sparkContext.broadcast(self)
        return self._shared

    @property
    def counter(self) -> TermCounter:
        if self._counter is None:
            self._counter = TermCounter(self.hashes)
        return self._counter

    def votes(self, queries: list[tuple]) -> list[float]:
        """The votes for examples (terms, counts, toxic), each without itself."""
        out = []
        for at in range(0, len(queries), QUERIES):
            some = queries[at:at + QUERIES]
            found = iter(self.examples.search([q[:2] for q in some if len(q[0])]))
            out += [self.examples.share(next(found) if len(q[0]) else None, q[2]) for q in some]
        return out

    def calibrate(self, votes: np.ndarray, toxic: np.ndarray) -> None:
        """Fit the curve on each example's vote without itself, each class with its true weight."""
        weights = np.array(self.examples.weight)[toxic]
        self.curve = _logistic(_logit(votes), toxic.astype(float), weights)

    def score(self, queries: list[tuple], curve: tuple[float, float]) -> list[tuple[float, list]]:
        """(score, evidence) of each (terms, counts)."""
        if self.examples is None:
            return [(self.share, [])] * len(queries)
        keys = [_key(*q) for q in queries]
        new = {key: q for key, q in zip(keys, queries) if key not in self._known}
        if len(self._known) + len(new) > 4_000:
            new = dict(zip(keys, queries))
            self._known.clear()
        found = iter(self.examples.search([q for q in new.values() if len(q[0])]))
        for key, q in new.items():
            near = next(found) if len(q[0]) else None
            self._known[key] = (float(_logit(np.array(self.examples.share(near)))), self.examples.evidence(near))
        risen = (curve[0] * vote + curve[1] for vote, _ in map(self._known.__getitem__, keys))
        return [(1 / (1 + math.exp(-max(-50.0, min(50.0, z)))), self._known[key][1]) for key, z in zip(keys, risen)]


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and offset by Newton's method; a slope that is not positive means no curve."""
    features, beta = np.stack([x, np.ones_like(x)], axis=1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(features @ beta, -50, 50)))
        gradient = features.T @ (w * (y - p)) - ridge * (beta - np.array([1.0, 0.0]))
        step = np.linalg.solve(features.T @ (features * (w * p * (1 - p))[:, None]) + ridge * np.eye(2), gradient)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return (float(beta[0]), float(beta[1])) if beta[0] > 0 else (1.0, 0.0)


def fit(documents: DataFrame, labels: DataFrame, *, examples: int = EXAMPLES):
    """(model, vectors): the model and the term counts of all documents, not computed yet."""
    train = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id"))).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic"))
    # Labels of other documents take no place among the examples and count for no class.
    train = train.join(documents.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi")
    sample = stage_table(
        top_by(train, ["toxic"], [F.xxhash64("doc_id"), F.col("doc_id")], examples, "n").select(
            F.col("doc_id").alias("example"), "toxic"), "examples",
    )
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # At most 2 * examples ids: the size of the broadcast is a parameter.
    taught = stage_table(
        texts.join(F.broadcast(sample), F.col("doc_id") == F.col("example")).select("doc_id", "text", "toxic")
        .dropDuplicates(["doc_id"]), "example_texts"
    )
    terms, in_toxic, in_clean = example_terms(taught)
    hashes = term_hashes(terms)
    vectors = term_vectors(texts, hashes)
    sums = {r.toxic: r.n for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    total = sum(sums.values())
    share = sums.get(1, 0) / total if total else 0.0
    toxic_of = {r.doc_id: r.toxic for r in taught.select("doc_id", "toxic").collect()}  # 2 * examples at most
    have = Counter(toxic_of.values())
    if not len(terms) or not have[0] or not have[1]:
        return ToxicityModel(terms, hashes, None, share), vectors
    rows = []
    taught_vectors = stage_table(term_vectors(taught, hashes), "example_vectors")
    for batch in taught_vectors.toArrow().to_batches():
        found, counts = batch.column("terms"), batch.column("counts")
        for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
            rows.append((doc_id, found[i].values.to_numpy(), counts[i].values.to_numpy(), toxic_of[doc_id]))
    rows.sort(key=lambda r: r[0])
    idf = np.log((1 + len(rows)) / (1 + in_toxic + in_clean)) + 1
    apart = np.abs(np.log((in_toxic + 0.5) / (have[1] + 1)) - np.log((in_clean + 0.5) / (have[0] + 1)))
    scale = (have[0] + have[1]) / total
    weight = (sums.get(0, 0) / have[0] * scale, sums.get(1, 0) / have[1] * scale)
    steer = np.where(apart < LEAST_APART, 0.0, apart * apart)
    model = ToxicityModel(terms, hashes, Examples(idf, rows, weight, steer=steer), share)
    del rows
    votes = _example_votes(taught_vectors, model, toxic_of).toPandas().sort_values(["toxic", "vote"])
    model.calibrate(votes["vote"].to_numpy(), votes["toxic"].to_numpy())
    return model, vectors


def _example_votes(vectors: DataFrame, model: ToxicityModel, toxic_of: dict) -> DataFrame:
    """vote and toxic of each example, the vote without itself; at most two classes of examples."""
    shared = model.shared(vectors.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            toxic = [toxic_of[i] for i in batch.column("doc_id").to_pylist()]
            votes = model.votes([(*q, y) for q, y in zip(_queries(batch), toxic)])
            yield pa.RecordBatch.from_arrays([pa.array(votes, pa.float64()), pa.array(toxic, pa.int64())], names=["vote", "toxic"])

    return vectors.repartition(vectors.sparkSession.sparkContext.defaultParallelism).mapInArrow(run, "vote double, toxic long")


def _queries(batch: pa.RecordBatch) -> list[tuple]:
    terms, counts = ([one.values.to_numpy() for one in batch.column(c)] for c in ("terms", "counts"))
    return list(zip(terms, counts))


def score_vectors(vectors: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score, predicted and evidence for term counts of documents."""
    shared, curve = model.shared(vectors.sparkSession), model.curve

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, QUERIES):
                some = batch.slice(at, QUERIES)
                yield _scored(some.select(["doc_id"]), shared.value, curve, _queries(some))

    return vectors.mapInArrow(run, f"doc_id long, score double, predicted int, evidence {_EVIDENCE}")


def score(documents: DataFrame, model: ToxicityModel, *, text: str = "text") -> DataFrame:
    """``documents`` with score, predicted and evidence, in one pass over the texts."""
    kept = [c for c in documents.columns if c not in ("score", "predicted", "evidence")]
    rows = documents.select(*[F.col(f"`{c}`") for c in kept])
    shared, curve = model.shared(documents.sparkSession), model.curve

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, QUERIES):
                some = batch.slice(at, QUERIES)
                yield _scored(some, model, curve, model.counter.vectors(some.column(kept.index(text)).to_pylist()))

    schema = StructType(list(rows.schema.fields)).add("score", "double").add("predicted", "integer")
    return rows.mapInArrow(run, schema.add("evidence", DataType.fromDDL(_EVIDENCE)))


def _scored(batch: pa.RecordBatch, model: ToxicityModel, curve: tuple, queries: list[tuple]) -> pa.RecordBatch:
    found = model.score(queries, curve)
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.float64())]))
    evidence = [[dict(zip(("doc_id", "similarity", "toxic"), e)) for e in f[1]] for f in found]
    return pa.RecordBatch.from_arrays(
        [*batch.columns, pa.array([f[0] for f in found], pa.float64()),
         pa.array([int(f[0] >= 0.5) for f in found], pa.int32()), pa.array(evidence, kind)],
        names=[*batch.schema.names, "score", "predicted", "evidence"],
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model, _ = fit(documents, table(spark, sf_dir, "labels"))
    scored = score(documents, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "evidence")
