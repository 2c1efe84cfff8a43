"""BM25 search over a document-partitioned inverted index with block-max postings.

The documents of a task are cut into segments of a bounded number of tokens. A segment numbers its documents in id order
and holds the postings of each term by document, in blocks of ``BLOCK_DOCS`` consecutive documents with the largest gain of
each block. For a query, the sum of its weights times the blocks' largest gains bounds every score in a range of documents:
ranges that can't reach the k-th score seen so far are passed over. A task emits k rows for each query, or its part of a
summary; no pair of a query and a document is shuffled.

More than a few queries meet a segment in batches (``Crowd``): the lightest terms of a query, which together can't reach its
k-th score, are not searched, only looked up in the documents that hold one of its other terms and may still reach it.

Documents that share no term with a query score 0 and take part like all others, from the same pass.

Segments are built on the fly (``searched`` of documents) or written once as an index (``index_table``), in rows that make
up segments when they are read, and searched as often as needed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEGMENT_TOKENS = 1 << 21
SEGMENT_DOCS = 1 << 16
# a row of a written index holds so many tokens; rows are small because readers hold many at once, and met again as segments
ROW_TOKENS = 1 << 17
BLOCK_DOCS = 256
# queries are sent to the tasks in sets of about so many queries and so many of their terms; each set reads all segments
QUERY_SET = 1_000_000
FEW = 64  # so many queries meet a segment one after the other, more of them in batches
_CELLS = 1 << 18  # pairs of a batch's queries and a segment's documents
_POSTINGS = 1 << 21  # postings of a batch, if it has more than one query
_TABLED = 1 << 22  # cells of the table that knows the gains of a segment's most frequent terms by document
_LIGHT = 0.5  # share of the bar that light terms reach at most; up to 1 is right, more of them leave more documents to look up
_LEAD = 512  # documents that give a first bar to queries without one
SCORE_DIGITS = 9  # sums come in no fixed order; ranking compares them at this many digits, so that exact copies tie
_SLACK = 2e-9
_ROWS_OUT = 1 << 17


@dataclass(frozen=True)
class Gain:
    """What an occurrence is worth: tf (k1 + 1) / (tf + k1 (1 - b + b length / mean length))."""

    k1: float
    b: float
    mean_length: float

    def of(self, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        norm = 1 - self.b + self.b * length / self.mean_length if self.mean_length else 1 - self.b + 0 * length
        return tf * (self.k1 + 1) / (tf + self.k1 * norm)


@dataclass(frozen=True)
class Asked:
    """A set of weighted queries: ids, the terms they use, and per query its terms' numbers and weights."""

    ids: pa.Array
    terms: pa.Array
    starts: np.ndarray
    term: np.ndarray
    weight: np.ndarray

    @staticmethod
    def of(queries: pa.Table, weights: pa.Table) -> Asked:
        """From ``queries(query_id)`` and ``weights(query_id, term, weight)``."""
        ids = pc.unique(queries["query_id"])
        ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
        terms = pc.unique(weights["term"])
        terms = terms.combine_chunks() if isinstance(terms, pa.ChunkedArray) else terms
        query = pc.index_in(weights["query_id"], value_set=ids).to_numpy().astype(np.int64)
        term = pc.index_in(weights["term"], value_set=terms).to_numpy().astype(np.int64)
        key, at = np.unique(query * max(1, len(terms)) + term, return_inverse=True)
        weight = np.bincount(at, weights=weights["weight"].to_numpy(), minlength=len(key))  # rows of one query add up
        query, term = key // max(1, len(terms)), key % max(1, len(terms))
        return Asked(ids, terms, np.searchsorted(query, np.arange(len(ids) + 1)), term, weight)


def _spans(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, … of each span, one span after the other."""
    total = int(length.sum())
    return np.repeat(start - np.cumsum(length) + length, length) + np.arange(total)


class Segment:
    """Documents in id order with their postings: term ``t`` has ``docs[at[t]:at[t + 1]]`` and the ``gain`` there."""

    def __init__(self, ids: pa.Array, at: np.ndarray, docs: np.ndarray, gain: np.ndarray):
        self.ids, self.n, self.at, self.docs, self.gain = ids, len(ids), at, docs, gain
        self.ranges = -(-self.n // BLOCK_DOCS)
        term = np.repeat(np.arange(len(at) - 1), np.diff(at))
        place = docs // BLOCK_DOCS
        fresh = np.ones(len(docs), bool)
        fresh[1:] = (term[1:] != term[:-1]) | (place[1:] != place[:-1])
        self.block = np.flatnonzero(fresh)  # first posting of each block
        self.size = np.diff(np.append(self.block, len(docs)))
        self.place = place[self.block]
        self.most = np.maximum.reduceat(gain, self.block) if len(docs) else gain
        self.blocks_at = np.searchsorted(self.block, at)

    @staticmethod
    def of_texts(ids: pa.Array, tokens: pa.Array, gain: Gain, terms: pa.Array | None = None) -> tuple[Segment, pa.Array]:
        """The segment of some documents, and its terms: those given, or else all."""
        order = pc.sort_indices(ids, null_placement="at_start")
        ids, tokens = ids.take(order), tokens.take(order)
        length = pc.list_value_length(tokens).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = tokens.flatten()
        if terms is None:
            terms = pc.unique(flat)
            terms = terms.take(pc.sort_indices(terms))
        number = pc.fill_null(pc.index_in(flat, value_set=terms), -1).to_numpy().astype(np.int64)
        doc = np.repeat(np.arange(len(ids)), length)[number >= 0]
        key, tf = np.unique(number[number >= 0] * max(1, len(ids)) + doc, return_counts=True)
        term, doc = key // max(1, len(ids)), key % max(1, len(ids))
        return Segment(ids, np.searchsorted(term, np.arange(len(terms) + 1)), doc, gain.of(tf, length[doc])), terms

    def blocks_of(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Blocks of the terms of a query, and the weight in each."""
        start = self.blocks_at[terms]
        length = self.blocks_at[terms + 1] - start
        return _spans(start, length), np.repeat(weights, length)

    def scored(self, blocks: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of the documents in some blocks, in order."""
        size = self.size[blocks]
        posting = _spans(self.block[blocks], size)
        docs = self.docs[posting]
        held, at = np.unique(docs, return_inverse=True)
        return held, np.bincount(at, weights=np.repeat(weights, size) * self.gain[posting], minlength=len(held))


class Best:
    """The k best documents of each query so far, and the score below which nothing matters any more."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.found: list[tuple[np.ndarray, np.ndarray] | None] = [None] * queries  # scores and ids
        self.least = np.full(queries, -np.inf)

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if self.found[query] is not None:
            scores, ids = (np.concatenate(x) for x in zip(self.found[query], (scores, ids)))
        if len(scores) > self.k:
            first = np.lexsort((ids, -np.round(scores, SCORE_DIGITS)))[: self.k]
            scores, ids = scores[first], ids[first]
        self.found[query] = scores, ids
        if len(scores) == self.k:
            self.least[query] = np.round(scores, SCORE_DIGITS).min()

    def meet(self, segment: Segment, asked: Asked) -> None:
        ids = segment.ids.to_numpy(zero_copy_only=False)
        ids = ids.astype(str) if ids.dtype == object else ids
        for q in range(len(asked.ids)):
            own = slice(asked.starts[q], asked.starts[q + 1])
            blocks, weights = segment.blocks_of(asked.term[own], asked.weight[own])
            if self.least[q] > 0:  # documents without a common term don't matter
                if not len(blocks):
                    continue
                bound = np.bincount(segment.place[blocks], weights=np.maximum(weights, 0) * segment.most[blocks], minlength=segment.ranges)
                if bound.max() < self.least[q] - _SLACK:
                    continue
                top = segment.place[blocks] == bound.argmax()  # the most promising range first, which raises the bar
                self._keep(q, ids, *segment.scored(blocks[top], weights[top]))
                rest = ~top & (bound >= self.least[q] - _SLACK)[segment.place[blocks]]
                if rest.any():
                    self._keep(q, ids, *segment.scored(blocks[rest], weights[rest]))
                continue
            docs, scores = segment.scored(blocks, weights)
            # among the first documents by id are enough without a common term
            none = np.ones(min(segment.n, self.k + len(docs)), bool)
            none[docs[docs < len(none)]] = False
            none = np.flatnonzero(none)[: self.k]
            self._keep(q, ids, np.concatenate([docs, none]), np.concatenate([scores, np.zeros(len(none))]))

    def _keep(self, query: int, ids: np.ndarray, docs: np.ndarray, scores: np.ndarray) -> None:
        fit = scores >= self.least[query] - _SLACK
        if fit.any():
            docs, scores = docs[fit], scores[fit]
            if len(docs) > self.k:
                first = np.lexsort((docs, -np.round(scores, SCORE_DIGITS)))[: self.k]
                docs, scores = docs[first], scores[first]
            self.add(query, scores, ids[docs])


class Crowd:
    """``Best`` of many queries at once: rows ``query, score, id`` in ``found``, and the bars in ``least``."""

    def __init__(self, asked: Asked, k: int):
        self.k, self.starts, self.n = k, asked.starts, len(asked.ids)
        query = np.repeat(np.arange(self.n), np.diff(asked.starts))
        lightest = np.lexsort((asked.weight, query))  # terms of a query by rising weight
        self.query, self.term, self.weight = query, asked.term[lightest], asked.weight[lightest]
        self.least = np.full(self.n, -np.inf)
        self.found: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def meet(self, segment: Segment) -> None:
        if not segment.n:
            return
        size, most = np.diff(segment.at), np.zeros(len(segment.at) - 1)
        most[size > 0] = np.maximum.reduceat(segment.gain, segment.at[:-1][size > 0]) if len(segment.gain) else 0.0
        bound = np.maximum(self.weight, 0) * most[self.term]
        reached = np.bincount(self.query, weights=bound, minlength=self.n)
        barred = self.least > 0
        rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        table = _Gains(segment)
        for queries in (np.flatnonzero(~barred), np.flatnonzero(barred & (reached >= self.least - _SLACK))):
            for first in range(0, len(queries), max(1, _CELLS // segment.n)):
                some = queries[first : first + max(1, _CELLS // segment.n)]
                rows += self._batches(segment, table, some, bound, size)
        ids = segment.ids.to_numpy(zero_copy_only=False)
        self._add(rows, ids.astype(str) if ids.dtype == object else ids)

    def _batches(self, segment: Segment, table: _Gains, queries: np.ndarray, bound: np.ndarray, size: np.ndarray) -> Iterator[tuple]:
        """The rows ``query, score, document`` that may be among the best of some queries, all with a bar or all without."""
        length = self.starts[queries + 1] - self.starts[queries]
        pair, at = _spans(self.starts[queries], length), np.repeat(np.arange(len(queries)), length)
        start = np.cumsum(length) - length
        upto = np.concatenate([[0.0], np.cumsum(bound[pair])])
        upto = upto[1:] - upto[start][at]
        light = upto < _LIGHT * (self.least[queries] - _SLACK)[at]
        # what the light terms of a query add at most
        lights = np.bincount(at[light], minlength=len(queries))
        rest = np.where(lights > 0, upto[start + lights - 1] if len(upto) else 0.0, 0.0)
        heavy = np.flatnonzero(~light)
        postings = np.bincount(at[heavy], weights=size[self.term[pair[heavy]]], minlength=len(queries)).astype(np.int64)
        ends, first = np.cumsum(postings), 0
        while first < len(queries):
            last = int(np.searchsorted(ends, (ends[first - 1] if first else 0) + _POSTINGS, "right"))
            last = min(max(last, first + 1), len(queries))
            own = heavy[np.searchsorted(at[heavy], first) : np.searchsorted(at[heavy], last)]
            total = self._totals(segment, pair[own], at[own] - first, last - first)
            here = queries[first:last]
            if not self.least[here[0]] > 0:
                yield self._opened(here, total)
            else:
                q, doc = _cells(total >= (self.least[here] - _SLACK - rest[first:last])[:, None])
                yield self._looked_up(table, here, q, doc, total[q, doc], self.starts[here], lights[first:last], start[first:last], upto, bound)
            first = last

    def _totals(self, segment: Segment, pair: np.ndarray, at: np.ndarray, queries: int) -> np.ndarray:
        """Scores of all documents by some terms of the queries."""
        term = self.term[pair]
        length = segment.at[term + 1] - segment.at[term]
        posting = _spans(segment.at[term], length)
        cell = np.repeat(at * segment.n, length) + segment.docs[posting]
        weights = np.repeat(self.weight[pair], length) * segment.gain[posting]
        return np.bincount(cell, weights=weights, minlength=queries * segment.n).reshape(queries, segment.n)

    def _opened(self, queries: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Without a bar, documents that share no term count like all others; documents are in id order."""
        n, k = total.shape[1], self.k
        bar = np.zeros(len(queries))
        if k <= min(n, _LEAD):
            bar = np.partition(total[:, :_LEAD], min(n, _LEAD) - k, axis=1)[:, min(n, _LEAD) - k]
        mask = total >= (np.where(bar > _SLACK, bar - _SLACK, np.inf))[:, None]
        some = np.flatnonzero(bar <= _SLACK)
        if len(some):
            score = np.round(total[some], SCORE_DIGITS)
            least = np.partition(score, n - k, axis=1)[:, n - k] if k < n else score.min(axis=1)
            above, equal = score > least[:, None], score == least[:, None]
            mask[some] = above | (equal & (np.cumsum(equal, axis=1) <= k - above.sum(axis=1)[:, None])) if k < n else True
        q, doc = _cells(mask)
        return queries[q], total[q, doc], doc

    def _looked_up(self, table: _Gains, queries, q, doc, score, starts, lights, start, upto, bound) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Light terms are added to the scores of candidates, the heaviest first, as long as these may reach the bar."""
        done = []
        bars = self.least[queries] - _SLACK
        step = 1
        while len(q):
            more = lights[q] >= step
            if not more.all():
                done.append((q[~more], score[~more], doc[~more]))
                q, doc, score = q[more], doc[more], score[more]
            place = lights[q] - step
            pair = starts[q] + place
            score = score + self.weight[pair] * table.at(self.term[pair], doc)
            rest = upto[start[q] + place] - bound[pair]
            keep = score + rest >= bars[q]
            q, doc, score = q[keep], doc[keep], score[keep]
            step += 1
        if not done:
            return queries[:0], np.zeros(0), np.zeros(0, np.int64)
        q, score, doc = (np.concatenate(x) for x in zip(*done))
        return queries[q], score, doc

    def _add(self, rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], ids: np.ndarray) -> None:
        """The k best of the rows at hand and those found before; a query without new rows stays as it is."""
        query, score, doc = (np.concatenate(x) for x in zip(*rows)) if rows else (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
        if self.found is None:
            self.found = query[:0], score[:0], ids[:0]
        if not len(query):
            return
        fresh = np.zeros(self.n, bool)
        fresh[query] = True
        old = fresh[self.found[0]]
        kept = [x[~old] for x in self.found]
        query, score, ids = (np.concatenate(x) for x in zip([x[old] for x in self.found], (query, score, ids[doc])))
        by = np.lexsort((ids, -np.round(score, SCORE_DIGITS), query))
        query = query[by]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        by, query, place = by[place < self.k], query[place < self.k], place[place < self.k]
        score = score[by]
        last = place == self.k - 1
        self.least[query[last]] = np.round(score[last], SCORE_DIGITS)
        self.found = tuple(np.concatenate(x) for x in zip(kept, (query, score, ids[by])))


def _cells(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the cells that are set."""
    cell = np.flatnonzero(mask)
    return cell // mask.shape[1], cell % mask.shape[1]


class _Gains:
    """The gain of a term in a document of a segment: from a table for frequent terms, by search for others."""

    def __init__(self, segment: Segment):
        self.segment = segment
        size = np.diff(segment.at)
        most = np.argsort(-size, kind="stable")[: _TABLED // max(1, segment.n)]
        self.row = np.full(len(size), -1)
        self.row[most] = np.arange(len(most))
        self.table: np.ndarray | None = None
        self.key: np.ndarray | None = None

    def at(self, term: np.ndarray, doc: np.ndarray) -> np.ndarray:
        segment = self.segment
        if self.table is None:
            held = np.repeat(np.arange(len(segment.at) - 1), np.diff(segment.at))
            tabled = self.row[held] >= 0
            self.table = np.zeros((int(self.row.max(initial=-1)) + 1, segment.n))
            self.table[self.row[held[tabled]], segment.docs[tabled]] = segment.gain[tabled]
            self.key = held * segment.n + segment.docs
        row = self.row[term]
        if (row >= 0).all():
            return self.table[row, doc]
        found = np.where(row >= 0, self.table[row, doc] if len(self.table) else 0.0, 0.0)
        rare = np.flatnonzero(row < 0)
        key = term[rare] * segment.n + doc[rare]
        place = np.searchsorted(self.key, key)
        there = place < len(self.key)
        there[there] = self.key[place[there]] == key[there]
        found[rare[there]] = segment.gain[place[there]]
        return found


def _cut(batch: pa.RecordBatch, most: int | None = None) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Ids and tokens of a batch, in slices of bounded numbers of tokens and documents; a longer text is one by itself."""
    most = most or SEGMENT_TOKENS
    total = np.cumsum(pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < batch.num_rows:
        before = total[first - 1] if first else 0
        last = int(np.searchsorted(total, before + most, "right"))
        last = min(max(last, first + 1), first + SEGMENT_DOCS, batch.num_rows)
        yield batch.column(0).slice(first, last - first), batch.column(1).slice(first, last - first)
        first = last


def texts_reader(gain: Gain) -> Callable:
    """Segments of batches of ``(id, tokens)``, with the terms of the queries only."""

    def read(batches: Iterator[pa.RecordBatch], asked: Asked) -> Iterator[Segment]:
        for batch in batches:
            for ids, tokens in _cut(batch):
                yield Segment.of_texts(ids, tokens, gain, asked.terms)[0]

    return read


def index_reader(batches: Iterator[pa.RecordBatch], asked: Asked) -> Iterator[Segment]:
    """Segments of the rows of an index, with the terms of the queries only; rows are put together up to a segment's bounds."""
    parts: list[tuple[pa.Array, pa.Array, np.ndarray, np.ndarray, np.ndarray]] = []
    held = docs_held = 0
    for batch in batches:
        for row in range(batch.num_rows):
            ids, terms, at, docs, gain = (batch.column(c)[row].values for c in ("ids", "terms", "at", "docs", "gain"))
            if parts and (held + len(docs) > SEGMENT_TOKENS or docs_held + len(ids) > SEGMENT_DOCS):
                yield _together(parts, asked.terms)
                parts, held, docs_held = [], 0, 0
            # copies, so that the batch can go
            own = [x.take(pa.array(np.arange(len(x)))) for x in (ids, terms)]
            parts.append((*own, np.diff(at.to_numpy()), docs.to_numpy().copy(), gain.to_numpy().copy()))
            held, docs_held = held + len(docs), docs_held + len(ids)
    if parts:
        yield _together(parts, asked.terms)


def _together(parts: list[tuple[pa.Array, pa.Array, np.ndarray, np.ndarray, np.ndarray]], asked: pa.Array) -> Segment:
    """One segment of the documents of several rows: ids, terms with their number of postings, and of each posting its document and gain."""
    ids = pa.concat_arrays([p[0] for p in parts])
    order = pc.sort_indices(ids, null_placement="at_start").to_numpy().astype(np.int64)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    # the terms of all rows are looked up at once, since that makes a hash table of all terms asked for
    terms = pa.concat_arrays([p[1] for p in parts]).dictionary_encode()
    number = pc.fill_null(pc.index_in(terms.dictionary, value_set=asked), -1).to_numpy().astype(np.int64)[terms.indices.to_numpy()]
    term = np.repeat(number, np.concatenate([p[2] for p in parts]))
    first = np.repeat(np.cumsum([0, *(len(p[0]) for p in parts[:-1])]), [len(p[3]) for p in parts])
    known = np.flatnonzero(term >= 0)
    n = max(1, len(ids))
    key = term[known] * n + place[(np.concatenate([p[3] for p in parts]) + first)[known]]
    by = np.argsort(key)
    key, gain = key[by], np.concatenate([p[4] for p in parts])[known[by]]
    return Segment(ids.take(pa.array(order)), np.searchsorted(key, np.arange(len(asked) + 1) * n), key % n, gain)


def index_table(docs: DataFrame, gain: Gain) -> DataFrame:
    """``docs(id, tokens)`` -> rows of ``ROW_TOKENS`` tokens: ids, terms, at, docs, gain, the arrays of ``Segment``."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, tokens in _cut(batch, ROW_TOKENS):
                segment, terms = Segment.of_texts(ids, tokens, gain)
                arrays = [segment.ids, terms, pa.array(segment.at, pa.int32()), pa.array(segment.docs, pa.int32()), pa.array(segment.gain)]
                whole = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x) for x in arrays]
                yield pa.RecordBatch.from_arrays(whole, ["ids", "terms", "at", "docs", "gain"])

    kinds = {"ids": docs.schema[0].dataType, "terms": T.StringType(), "at": T.IntegerType(), "docs": T.IntegerType(), "gain": T.DoubleType()}
    return docs.mapInArrow(build, T.StructType([T.StructField(c, T.ArrayType(kind)) for c, kind in kinds.items()]))


def query_sets(queries: DataFrame, weights: DataFrame) -> list[Asked]:
    """Settled queries and their weighted terms, in sets of bounded size; usually one."""
    terms = weights.count()
    rows = queries.count()
    sets = 1 + max(terms, rows) // QUERY_SET
    number = F.pmod(F.xxhash64("query_id"), F.lit(sets))
    return [Asked.of(*(df.where(number == i).toArrow() for df in (queries.select("query_id"), weights))) for i in range(sets)]


def searched(source: DataFrame, read: Callable, sets: list[Asked], query_type: T.DataType, id_type: T.DataType, doc_id: str, k: int | None) -> DataFrame:
    """``(query_id, doc_id, score)``: per task the k best documents of each query, or all that share a term if k is None."""
    spark = source.sparkSession
    schema = T.StructType([T.StructField("query_id", query_type), T.StructField(doc_id, id_type), T.StructField("score", T.DoubleType())])
    names = schema.names

    def one(asked: Asked) -> DataFrame:
        sent = spark.sparkContext.broadcast(asked)

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            asked, kept, kind = sent.value, None, None
            if len(asked.ids) > FEW:
                yield from crowd(batches, asked)
                return
            for segment in read(batches, asked):
                kept, kind = kept or Best(len(asked.ids), k), segment.ids.type
                kept.meet(segment, asked)
            if kept is not None:
                for first in range(0, len(asked.ids), max(1, _ROWS_OUT // k)):
                    rows = [(q, *kept.found[q]) for q in range(first, min(first + max(1, _ROWS_OUT // k), len(asked.ids))) if kept.found[q] is not None]
                    if rows:
                        query = np.repeat([q for q, *_ in rows], [len(s) for _, s, _ in rows])
                        ids = pa.array(np.concatenate([i for *_, i in rows])).cast(kind)
                        yield pa.RecordBatch.from_arrays([asked.ids.take(pa.array(query)), ids, pa.array(np.concatenate([s for _, s, _ in rows]))], names)

        def crowd(batches: Iterator[pa.RecordBatch], asked: Asked) -> Iterator[pa.RecordBatch]:
            kept, kind = Crowd(asked, k), None
            for segment in read(batches, asked):
                kind = segment.ids.type
                kept.meet(segment)
            query, score, ids = kept.found or ((), (), ())
            for a in range(0, len(query), _ROWS_OUT):
                some = slice(a, a + _ROWS_OUT)
                yield pa.RecordBatch.from_arrays([asked.ids.take(pa.array(query[some])), pa.array(ids[some]).cast(kind), pa.array(score[some])], names)

        def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            asked = sent.value
            for segment in read(batches, asked):
                for q in range(len(asked.ids)):
                    own = slice(asked.starts[q], asked.starts[q + 1])
                    docs, scores = segment.scored(*segment.blocks_of(asked.term[own], asked.weight[own]))
                    if len(docs):
                        query = asked.ids.take(pa.array(np.full(len(docs), q)))
                        yield pa.RecordBatch.from_arrays([query, segment.ids.take(pa.array(docs)), pa.array(scores)], names)

        if k is None:
            return source.mapInArrow(every, schema)
        # every task emits k rows of each query and begins without a bar, so there are no more tasks than cores
        return source.coalesce(spark.sparkContext.defaultParallelism).mapInArrow(best, schema)

    found = one(sets[0])
    for asked in sets[1:]:
        found = found.unionByName(one(asked))
    return found


def totals(source: DataFrame, read: Callable, sets: list[Asked]) -> DataFrame:
    """Per task ``(matched, nonzero, total, best)`` over the scores of all pairs that share a term."""
    spark = source.sparkSession

    def one(asked: Asked) -> DataFrame:
        sent = spark.sparkContext.broadcast(asked)

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            asked, matched, nonzero, total, best = sent.value, 0, 0, 0.0, None
            for segment in read(batches, asked):
                for q in range(len(asked.ids)):
                    own = slice(asked.starts[q], asked.starts[q + 1])
                    _, scores = segment.scored(*segment.blocks_of(asked.term[own], asked.weight[own]))
                    if len(scores):
                        matched, nonzero, total = matched + len(scores), nonzero + int(np.count_nonzero(scores)), total + float(scores.sum())
                        best = float(scores.max()) if best is None else max(best, float(scores.max()))
            columns = [pa.array([matched]), pa.array([nonzero]), pa.array([total]), pa.array([best], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["matched", "nonzero", "total", "best"])

        return source.mapInArrow(summed, "matched bigint, nonzero bigint, total double, best double")

    found = one(sets[0])
    for asked in sets[1:]:
        found = found.unionByName(one(asked))
    return found
