"""Benchmark decontamination on a distributed positional inverted index.

Index: for every training text, all its terms with the positions of each, as inverted lists (terms ascending, list ends, positions). The
index is written once, in shards of documents, so that lists of one document meet without a shuffle.

Queries: the test side is a table of pieces of items, of at most PIECE windows each, numbered in order. A window of 13 consecutive item words
(a shorter item is one window) is an exact phrase. Its terms are ordered by how many documents hold them, the rarest first; the
rarest term's positions less its offset in the window are the candidate starts, and each further term's list, less its
offset, is intersected with them by binary search. Proximity: all terms of a window within its length plus ``slop``
words, in any order, around a position of the rarest term.

Pieces travel with the tasks in slices of about SLICE_WORDS words (a piece more at most): the driver holds one slice at a time, its distinct
terms and how many documents hold each; more slices are more passes over the index, whose finds are united by document.
Words are compared by 32 bits of a hash: a false hit needs one unlike word of equal bits in a passage that agrees otherwise.

Cases: null and empty texts have no words and no hits; an item without words has no window, one without id the id ""; equal items all
match; a text of any length is one row. Repeated rows give repeated rows. Other columns are left out.
Empty tables give no rows, or rows without hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_limits, cut, running
from .words import ALNUM, hashes

WINDOW, PIECE, SLICE_WORDS = 13, 4096, 400_000
INDEX = "key long, doc_id long, n_words long, terms array<int>, ends array<int>, positions array<int>"
HITS = "key long, starts array<int>, stops array<int>, items array<string>, near array<string>"
#: Candidates that are worked on at a time.
SOME = 200_000


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), type=pa.int32()), pa.array(values, type=kind))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and where each list starts."""
    where = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[where[0] : where[-1]] if len(column) else np.zeros(0), where - where[0]


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The words of the texts as 32 bits, and where each text's begin and the last end."""
    h, at = hashes(texts, ALNUM)
    return (h >> np.uint64(32)).astype(np.uint32).view(np.int32), at


def _runs(x: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate((np.ones(min(1, len(x)), dtype=bool), x[1:] != x[:-1])))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """INDEX, a row a text: its inverted lists. ``key`` numbers the rows; it holds once the index is written."""
    arrow_limits(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 40
        for batch in batches:
            h, at = _terms(batch.column(1))
            order = np.concatenate([np.zeros(0, dtype=np.int64), *(at[d] + np.argsort(h[at[d] : at[d + 1]], kind="stable") for d in range(batch.num_rows))])
            doc = np.repeat(np.arange(batch.num_rows), np.diff(at))
            term = h[order]
            first = _runs(term.astype(np.int64) + (doc << 33))
            lists = np.bincount(doc[first], minlength=batch.num_rows)
            ends = np.append(first[1:], len(term))[: len(first)] - at[doc[first]]
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(key, key + rows)), batch.column(0).cast(pa.int64()), pa.array(np.diff(at)), _lists(term[first], lists, pa.int32()),
                _lists(ends.astype(np.int32), lists, pa.int32()), _lists((order - at[doc]).astype(np.int32), np.diff(at), pa.int32()),
            ], names=["key", "doc_id", "n_words", "terms", "ends", "positions"])
            key += rows

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col).mapInArrow(run, INDEX)


def item_pieces(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, words, at, slice): the words of each item in pieces of at most PIECE windows, numbered from 0, and each piece's slice."""
    arrow_limits(items.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, at = _terms(batch.column(1))
            n = np.diff(at)
            count = np.where(n > 0, -(-np.maximum(n - window + 1, 1) // PIECE), 0)
            own = np.repeat(np.arange(len(n)), count)
            piece = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
            begin, size = at[own] + piece * PIECE, np.minimum(PIECE + window - 1, n[own] - piece * PIECE)
            place = np.repeat(begin, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own)), pa.array(piece), _lists(h[place], size, pa.int32())], names=["item", "piece", "words"])

    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    pieces = named.mapInArrow(run, "item string, piece long, words array<int>")
    placed = running(pieces.withColumn("n", F.size("words")), [F.col("item"), F.col("piece"), F.col("n"), F.xxhash64("words")], {"before": "n"}, "item-order")
    return placed.select("item", "words", "at", F.floor(F.col("before") / SLICE_WORDS).alias("slice"))


class Slice:
    """The windows of some pieces: their terms in order, each window's terms by rarity with their offsets."""

    def __init__(self, pieces: pa.Table, window: int):
        words, at = _flat(pieces.column("words").combine_chunks())
        n = np.diff(at)
        count = np.maximum(n - window + 1, 1)
        self.length = np.repeat(np.minimum(n, window), count)
        begin = np.repeat(at[:-1], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        self.names, own = np.unique(np.array(pieces.column("item").to_pylist(), dtype=object), return_inverse=True)
        self.item = np.repeat(own, count)
        self.terms, number = np.unique(words, return_inverse=True)
        width = int(self.length.max(initial=0))
        place = np.arange(width)
        inside = place < self.length[:, None]
        self.asked = np.where(inside, number[np.minimum(begin[:, None] + place, len(number) - 1)], -1).astype(np.int32)
        self.off = np.tile(place.astype(np.int32), (len(begin), 1))

    def rarest_first(self, holders: np.ndarray) -> None:
        """Order each window's terms by how many documents hold them, ties by place; windows by their first term."""
        rare = np.where(self.asked >= 0, holders[self.asked], 1 << 62)
        order = np.argsort(rare, axis=1, kind="stable")
        self.asked, self.off = (np.take_along_axis(x, order, axis=1) for x in (self.asked, self.off))
        by_first = np.argsort(self.asked[:, 0], kind="stable")
        self.asked, self.off, self.length, self.item = self.asked[by_first], self.off[by_first], self.length[by_first], self.item[by_first]
        self.first_at = np.searchsorted(self.asked[:, 0], np.arange(len(self.terms) + 1))


def _known(terms: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``terms`` are among the ascending ``asked``, and where there."""
    place = np.minimum(np.searchsorted(asked, terms), len(asked) - 1)
    there = np.flatnonzero(asked[place] == terms)
    return there, place[there]


def holders(index: DataFrame, terms: np.ndarray) -> np.ndarray:
    """How many rows of the index hold each of the ascending terms."""
    sent = index.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(sent.value), dtype=np.int64)
        for batch in batches:
            n += np.bincount(_known(_flat(batch.column(0))[0], sent.value)[1], minlength=len(n))
        there = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(n[there])], names=["term", "n"])

    rows = index.select("terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(terms), dtype=np.int64)
    out[rows.column("term").to_numpy()] = rows.column("n").to_numpy()
    return out


class Lists:
    """The lists of a batch of the index that belong to a slice's terms, for intersection by binary search."""

    def __init__(self, batch: pa.RecordBatch, asked: Slice):
        terms, at = _flat(batch.column(2))
        ends, _ = _flat(batch.column(3))
        positions, p_at = _flat(batch.column(4))
        owner = np.repeat(np.arange(batch.num_rows), np.diff(at))
        stop = ends.astype(np.int64) + p_at[owner]
        begin = np.concatenate(([0], stop[:-1])).astype(np.int64) if len(stop) else stop
        there, self.term = _known(terms, asked.terms) if len(terms) else (np.zeros(0, dtype=np.int64),) * 2
        self.doc, self.n = owner[there], (stop - begin)[there]
        self.begin = np.cumsum(self.n) - self.n
        where = np.repeat(begin[there] - self.begin, self.n) + np.arange(self.n.sum())
        self.position = positions[where].astype(np.int64)
        self.width = len(asked.terms)
        self.names = self.doc * self.width + self.term  # ascending
        self.places = (np.repeat(np.arange(len(there)), self.n) << 32) + self.position  # ascending

    def of(self, doc: np.ndarray, term: np.ndarray) -> np.ndarray:
        """The list of each term in each document; -1: there is none."""
        name = doc * self.width + term
        at = np.minimum(np.searchsorted(self.names, name), len(self.names) - 1)
        return np.where((self.names[at] == name) & (term >= 0), at, -1)

    def hold(self, lists: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Whether each list holds the position."""
        place = (lists << 32) + position
        at = np.minimum(np.searchsorted(self.places, place), len(self.places) - 1)
        return (lists >= 0) & (position >= 0) & (self.places[at] == place)

    def within(self, lists: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether each list has a position from low up to high, not included."""
        base = np.maximum(lists, 0) << 32
        return (lists >= 0) & (np.searchsorted(self.places, base + np.maximum(low, 0)) < np.searchsorted(self.places, base + high))


def search(index: DataFrame, asked: Slice, slop: int) -> DataFrame:
    """HITS, a row for each text with a match of these windows: united spans, items with a phrase, items that are near."""
    sent = index.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = sent.value
        for batch in batches:
            lists, n_words = Lists(batch, asked), batch.column(1).to_numpy()
            hits, near = [(np.zeros(0, dtype=np.int64),) * 3], [(np.zeros(0, dtype=np.int64),) * 2]
            windows = asked.first_at[lists.term + 1] - asked.first_at[lists.term]
            anchors = np.flatnonzero(windows)  # lists of a window's rarest term
            each = np.repeat(anchors, lists.n[anchors])
            at = lists.position[np.repeat(lists.begin[anchors], lists.n[anchors]) + np.arange(len(each)) - np.repeat(np.cumsum(lists.n[anchors]) - lists.n[anchors], lists.n[anchors])]
            work = np.cumsum(windows[each])
            for some in np.split(np.arange(len(each)), np.searchsorted(work, np.arange(SOME, int(work[-1]), SOME))) if len(each) else ():
                m = windows[each[some]]
                row = some[np.repeat(np.arange(len(some)), m)]
                w = np.repeat(asked.first_at[lists.term[each[some]]], m) + np.arange(len(row)) - np.repeat(np.cumsum(m) - m, m)
                doc, anchor = lists.doc[each[row]], at[row]
                if slop >= 0:
                    near.append(_near(lists, doc, anchor, w, asked, slop))
                start = anchor - asked.off[w, 0]
                ok = (start >= 0) & (start + asked.length[w] <= n_words[doc])
                doc, start, w = doc[ok], start[ok], w[ok]
                for r in range(1, asked.asked.shape[1]):
                    want = asked.asked[w, r]
                    ok = (want < 0) | lists.hold(lists.of(doc, want), start + asked.off[w, r])
                    doc, start, w = doc[ok], start[ok], w[ok]
                    if not len(doc):
                        break
                hits.append((doc, start, w))
            doc, start, w = (np.concatenate(x) for x in zip(*hits))
            ndoc, nw = (np.concatenate(x) for x in zip(*near))
            found = np.unique(np.concatenate((doc, ndoc)))
            if len(found):
                spans = _united(np.searchsorted(found, doc), start, start + asked.length[w], len(found))
                named = [_distinct(np.searchsorted(found, d), asked.item[x], asked.names, len(found)) for d, x in ((doc, w), (ndoc, nw))]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(found)), *spans, *named], names=["key", "starts", "stops", "items", "near"])

    return index.select("key", "n_words", "terms", "ends", "positions").mapInArrow(run, HITS)


def _near(lists: Lists, doc, anchor, w, asked: Slice, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """(doc, window) where all of the window's terms stand within length + slop words that hold the anchor."""
    reach = asked.length[w] + slop
    for r in range(1, asked.asked.shape[1]):  # each term must be near at all, the rarest first
        want = asked.asked[w, r]
        ok = (want < 0) | lists.within(lists.of(doc, want), anchor - reach + 1, anchor + reach)
        doc, anchor, w, reach = doc[ok], anchor[ok], w[ok], reach[ok]
        if not len(doc):
            return doc, w
    whole = np.zeros(len(doc), dtype=bool)
    other = [(asked.asked[w, r] < 0, lists.of(doc, asked.asked[w, r])) for r in range(1, asked.asked.shape[1])]
    for first in range(int(reach.max(initial=0))):  # the span that begins so many words before the anchor
        todo = np.flatnonzero(~whole & (first < reach))
        for none, own in other:
            begin = anchor[todo] - first
            todo = todo[none[todo] | lists.within(own[todo], begin, begin + reach[todo])]
        whole[todo] = True
    return doc[whole], w[whole]


def _united(doc: np.ndarray, start: np.ndarray, stop: np.ndarray, rows: int) -> tuple[pa.Array, pa.Array]:
    """List columns of the starts and stops of the rows' spans, those that overlap or touch as one."""
    order = np.lexsort((start, doc))
    d, a, b = doc[order].astype(np.int64), start[order].astype(np.int64), stop[order].astype(np.int64)
    if len(d):
        top = np.maximum.accumulate(b + (d << 40))  # ends so far, within the row
        first = np.flatnonzero(np.concatenate(([True], (d[1:] != d[:-1]) | (a[1:] + (d[1:] << 40) > top[:-1]))))
        last = np.append(first[1:], len(d)) - 1
        d, a, b = d[first], a[first], top[last] - (d[first] << 40)
    sizes = np.bincount(d, minlength=rows)
    return _lists(a.astype(np.int32), sizes, pa.int32()), _lists(b.astype(np.int32), sizes, pa.int32())


def _distinct(doc: np.ndarray, item: np.ndarray, names: np.ndarray, rows: int) -> pa.Array:
    pairs = np.unique(doc.astype(np.int64) * len(names) + item)
    return _lists(names[pairs % len(names)], np.bincount(pairs // len(names), minlength=rows), pa.string())


def _merged(hits: DataFrame) -> DataFrame:
    """HITS with one row for each text, of the rows of several slices."""
    each = hits.groupBy("key").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "stops")], *[F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("items", "near")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, at = _flat(batch.column(1))
            spans = _united(np.repeat(np.arange(batch.num_rows), np.diff(at)), start, _flat(batch.column(2))[0], batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), *spans, batch.column(3), batch.column(4)], names=["key", "starts", "stops", "items", "near"])

    return each.mapInArrow(run, HITS)


def matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = -1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, starts, stops, items, near, a row a text: united spans [start, stop) of word positions in phrases, the ids (as strings)
    of items with a phrase, and of items that are near (slop < 0: none sought)."""
    index = cut(build_index(docs, id_col, text_col), "index")
    pieces = cut(item_pieces(items, window), "item-pieces")
    hits, count = None, int(pieces.agg(F.coalesce(F.max("slice") + 1, F.lit(0)).alias("n")).first().n)
    for k in range(count):
        asked = Slice(pieces.where(F.col("slice") == k).orderBy("at").toArrow(), window)
        asked.rarest_first(holders(index, asked.terms))
        found = search(index, asked, slop)
        hits = found if hits is None else hits.union(found)
    rows = index.select("key", "doc_id", "n_words")
    none = {"starts": "array<int>", "stops": "array<int>", "items": "array<string>", "near": "array<string>"}
    if hits is None:
        return rows.select("doc_id", "n_words", *[F.array().cast(kind).alias(c) for c, kind in none.items()])
    hits = cut(hits if count == 1 else _merged(hits), "hits")
    return rows.join(hits, "key", "left").select("doc_id", "n_words", *[F.coalesce(c, F.array().cast(kind)).alias(c) for c, kind in none.items()])


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = -1) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated (a twentieth of the words hit, or more), n_near."""
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    out = matches(docs, items, window, slop).select(
        "doc_id", "n_words", (total("stops") - total("starts")).alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ",").cast("binary"), 256).alias("items_sha256"), F.size("near").cast("long").alias("n_near"),
    )
    return out.withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))
