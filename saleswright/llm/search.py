"""Ranked lexical search by bag deduplication.

Every document is restricted to the vocabulary of the items: what remains of it
is a bag of terms with their counts, and a length class m. Documents with equal
bags and m score alike for every item, so they form a class: rows meet by a
hash of both, are compared in full, and each class is scored once. Its members
then follow in order of their ids. Of a class, no more members than results are
asked for can ever be listed, so each task keeps that many smallest ids before
anything is moved; a class that holds a third of all documents sends one row per
slice of its tasks.

Items are the stated queries. They are taken in blocks of bounded size, and a
block's vocabulary and postings go to all tasks.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fixed, slices

TOP = 50
#: Most (item, term) pairs of a block of items; an item with more has a block of its own.
BLOCK_POSTINGS = 500_000
#: Most cells of a score table and score summands that a task holds at a time.
_CELLS = 4_000_000
#: Rows among which a task looks for equal bags before the shuffle.
_NEAR = 20_000
_SALTS = 16

#: ASCII letters and digits, and all bytes of other characters, make up terms.
_BLANKED = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order; only A-Z are lowered."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_BLANKED).split()


@dataclass
class Block:
    """Items with their vocabulary; postings list each term's items."""

    item_ids: list = field(default_factory=list)
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    postings: list[list[int]] = field(default_factory=list)
    size: int = 0

    def add(self, item_id, words: set[bytes]) -> None:
        for word in words:
            number = self.vocabulary.setdefault(word, len(self.vocabulary))
            if number == len(self.postings):
                self.postings.append([])
            self.postings[number].append(len(self.item_ids))
        self.item_ids.append(item_id)
        self.size += len(words)


def blocks(items: DataFrame, most: int = BLOCK_POSTINGS) -> Iterator[Block]:
    """The items in blocks, read one partition at a time; those without a term are left out."""
    block = Block()
    for item_id, text in items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        if words := set(terms(text)):
            if block.size and block.size + len(words) > most:
                yield block
                block = Block()
            block.add(item_id, words)
    if block.size:
        yield block


def bags(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, bag``: all terms counted, and the known ones as pairs of number and count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.get
        for batch in slices(batches):
            counts, found = [], []
            for text in batch.column(1).to_pylist():
                words = terms(text)
                bag = Counter(map(number, words))
                bag.pop(None, None)
                counts.append(len(words))
                found.append(np.array(sorted(bag.items()), "<u4").tobytes())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "bag"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, bag binary")


def frequencies(found: DataFrame, size: int) -> np.ndarray:
    """In how many documents each known term occurs, counted in the tasks and summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size, dtype=np.int64)
        for batch in batches:
            pairs = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u4")
            seen += np.bincount(pairs[::2], minlength=size)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at])], ["term", "df"])

    counted = found.select("bag").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = np.zeros(size, dtype=np.int64)
    for term, n in counted.collect():  # one row per term of the block
        df[term] = n
    return df


def _in_order(ids: list) -> list:
    return sorted(ids, key=lambda x: (x is not None, x or 0))


def _near_classes(docs: int, total: int, top: int) -> Callable:
    """Rows of equal bag and m within a slice of a task become one, with its least ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, _NEAR):
            classes: dict[tuple[int, bytes], list] = {}
            for doc_id, n, bag in zip(*(batch.column(i).to_pylist() for i in range(3))):
                classes.setdefault((50 + 50 * n * docs // total, bag), []).append(doc_id)
            keys = [xxhash.xxh3_64_intdigest(bag, m & 0xFFFFFFFF) for m, bag in classes]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array(keys, dtype=np.uint64).view(np.int64)),
                    pa.array([m for m, _ in classes], pa.int64()),
                    pa.array([bag for _, bag in classes], pa.binary()),
                    pa.array([_in_order(ids)[:top] for ids in classes.values()], pa.list_(pa.int64())),
                ],
                ["key", "m", "bag", "ids"],
            )

    return run


def _classes(batches: Iterator[pa.RecordBatch], top: int) -> Iterator[tuple[int, bytes, list]]:
    """Classes of rows that are sorted by key, m and bag: equal keys are verified."""
    last: tuple[int, bytes] | None = None
    ids: list = []
    for batch in batches:
        for m, bag, new in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
            if last == (m, bag):
                ids = _in_order(ids + new)[:top]
                continue
            if last is not None:
                yield *last, ids
            last, ids = (m, bag), new
    if last is not None:
        yield *last, ids


class Scorer:
    """Scores classes for all items of a block and keeps what can be among the first ``top``."""

    def __init__(self, block: Block, weights: np.ndarray, top: int):
        self.weights, self.top, self.items = weights, top, len(block.item_ids)
        self.posting_ends = np.cumsum([0, *map(len, block.postings)])
        self.posted = np.array([i for p in block.postings for i in p], dtype=np.int64)
        self.least = np.ones(self.items, dtype=np.int64)
        self.ids: list[list] = []
        self.kept = np.empty((3, 0), dtype=np.int64)  # item, score, place in ids

    def _scores(self, ms: list[int], found: list[bytes]) -> np.ndarray:
        sizes = np.array([len(b) // 8 for b in found])
        pairs = np.frombuffer(b"".join(found), "<u4").astype(np.int64)
        term, tf = pairs[::2], pairs[1::2]
        row = np.repeat(np.arange(len(found)), sizes)
        part = self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * np.array(ms)[row]))
        start, times = self.posting_ends[term], np.diff(self.posting_ends)[term]
        scores = np.zeros(len(found) * self.items, dtype=np.int64)
        ends = np.cumsum(times)
        first = 0
        while first < len(term):  # a bounded number of summands at a time
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + _CELLS, "right")))
            n = times[first:last]
            each = np.repeat(np.arange(first, last), n)
            nth = np.arange(len(each)) - np.repeat(ends[first:last] - n - done, n)
            np.add.at(scores, row[each] * self.items + self.posted[start[each] + nth], part[each])
            first = last
        return scores.reshape(len(found), self.items)

    def add(self, classes: list[tuple[int, bytes, list]]) -> None:
        scores = self._scores([m for m, _, _ in classes], [b for _, b, _ in classes])
        if len(classes) > self.top:
            own = np.partition(scores, len(classes) - self.top, axis=0)[len(classes) - self.top]
            self.least = np.maximum(self.least, own)
        row, item = np.nonzero(scores >= self.least)
        new = np.stack([item, scores[row, item], row + len(self.ids)])
        self.ids += [ids for _, _, ids in classes]
        self.kept = np.concatenate([self.kept, new], axis=1)
        self._shrink()

    def _shrink(self) -> None:
        """Keep each item's first classes by score, then least member."""
        item, score, place = self.kept
        firsts = [self.ids[p][0] for p in place.tolist()]
        known = np.array([f is not None for f in firsts], dtype=bool)
        order = np.lexsort((np.array([f or 0 for f in firsts], dtype=np.int64), known, -score, item))
        order = order[_rank(item[order]) < self.top]
        item, score, place = self.kept[:, order]
        used, place = np.unique(place, return_inverse=True)
        self.ids = [self.ids[u] for u in used.tolist()]
        self.kept = np.stack([item, score, place])
        full = np.flatnonzero(_rank(item) == self.top - 1)
        self.least[item[full]] = np.maximum(self.least[item[full]], score[full])

    def documents(self) -> tuple[np.ndarray, list, np.ndarray]:
        """Item number, document id and score of the first documents of each item."""
        item, score, place = self.kept
        members = [self.ids[p] for p in place.tolist()]
        sizes = [len(m) for m in members]
        item, score = np.repeat(item, sizes), np.repeat(score, sizes)
        ids = [i for m in members for i in m]
        known = np.array([i is not None for i in ids], dtype=bool)
        order = np.lexsort((np.array([i or 0 for i in ids], dtype=np.int64), known, -score, item))
        order = order[_rank(item[order]) < self.top]
        return item[order], [ids[k] for k in order.tolist()], score[order]


def _rank(groups: np.ndarray) -> np.ndarray:
    """Place of each element within its run of equal values."""
    at = np.arange(len(groups))
    fresh = np.concatenate([[True], groups[1:] != groups[:-1]])[: len(groups)]
    return at - np.maximum.accumulate(np.where(fresh, at, 0)) if len(groups) else at


def _best(block: Block, weights: np.ndarray, top: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(block, weights, top)
        most = max(1, min(2000, _CELLS // scorer.items))
        waiting: list[tuple[int, bytes, list]] = []
        for found in _classes(batches, top):
            waiting.append(found)
            if len(waiting) == most:
                scorer.add(waiting)
                waiting = []
        if waiting:
            scorer.add(waiting)
        item, doc_id, score = scorer.documents()
        item_ids = [block.item_ids[i] for i in item.tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(item.astype(np.int32)), pa.array(item_ids, pa.int64()), pa.array(doc_id, pa.int64()), pa.array(score)],
            ["item", "item_id", "doc_id", "score"],
        )

    return run


def _first(rows: DataFrame, top: int) -> DataFrame:
    """The first rows of each item with their rank; parts of an item are cut beforehand."""
    part = F.pmod(F.xxhash64("doc_id"), F.lit(_SALTS))
    order = [F.desc("score"), F.asc_nulls_first("doc_id")]
    cut = rows.withColumn("part", part)
    cut = cut.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order)))
    cut = cut.filter(F.col("rank") <= top)
    ranked = cut.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return ranked.filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each item with a score above 0.

    Equal scores are ordered by id, a missing id first. Repeated rows of
    documents are listed each, and repeated rows of items answered each. Missing
    or empty texts hold no term: they are neither found nor counted, and as
    items they find nothing. Empty tables give no rows. The limit is per item;
    all documents are scored.
    """
    result = None
    for block in blocks(items, block_postings):
        found = fixed(bags(docs, block.vocabulary))
        count, total = found.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = frequencies(found, len(block.vocabulary))
        weights = np.array([math.floor(1000 * math.log((2 * count + 2) / (2 * n + 1))) for n in df.tolist()], dtype=np.int64)
        near = found.filter(F.length("bag") > 0).mapInArrow(
            _near_classes(count, total, top), "key long, m long, bag binary, ids array<long>"
        )
        met = near.repartition("key").sortWithinPartitions("key", "m", "bag")
        best = met.mapInArrow(_best(block, weights, top), "item int, item_id long, doc_id long, score long")
        ranked = _first(best, top)
        result = ranked if result is None else result.union(ranked)
    if result is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return result
