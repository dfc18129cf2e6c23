"""Benchmark passages in documents, by greedy string tiling.

Documents and benchmark items are word sequences without case and punctuation.
Seeds are windows of ``MIN_MATCH`` words: a rolling hash of every window of a
document is looked up among those of the items, which gives pairs of a document
and an item and the words they may share. Each pair is tiled: the longest
common runs of words not yet marked are marked again and again, the lengths
found by running Karp-Rabin with windows of halved steps, until none of
``MIN_MATCH`` words is left. An item is leaked if the tiles cover enough of its words, in
whatever order its passages come.

The benchmark is taken in blocks of bounded size, each held by every task while
all documents stream past, so neither side is ever joined all against all.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

MIN_MATCH = 5
COVERAGE = 0.8
#: Characters of benchmark text that a task holds at a time.
BLOCK_CHARS = 8_000_000

_WORD = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
LEAK = "doc_id long, item_id long, item_words long, tiled_words long, coverage double, n_tiles long, tiles array<struct<doc_word:long,item_word:long,words:long>>"


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def rolling(ids: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hash of every window of ``width`` ids, modulo 2**64."""
    if len(ids) < width:
        return np.empty(0, dtype=np.uint64)
    n = len(ids) - width + 1
    values = ids.astype(np.uint64) + np.uint64(1)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        out = out * _BASE + values[i : i + n]
    return out


class Windows:
    """Hashes of a sequence's windows of any width, from one running sum.

    The hash of a prefix is the sum of ids times powers of the base, modulo
    2**64; a window's is the difference of two, brought to the power zero.
    """

    def __init__(self, ids: np.ndarray):
        self.ids, n = ids, len(ids)
        powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]))
        self.back = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, _INVERSE)]))
        values = (ids.astype(np.uint64) + np.uint64(1)) * powers[:-1]
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
        self.free = ids >= 0

    def of(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and places of the windows without a marked word."""
        if len(self.ids) < width:
            return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
        blocked = np.concatenate([[0], np.cumsum(~self.free)])
        at = np.flatnonzero(blocked[width:] == blocked[:-width])
        return (self.sums[at + width] - self.sums[at]) * self.back[at], at


def _mark(doc: Windows, item: Windows, width: int) -> list[tuple[int, int, int]]:
    """Mark common runs of ``width`` words, in the order of the item's, then the document's words.

    A document place that is taken stays so, and is passed over once per hash.
    """
    hashes, places = doc.of(width)
    own, at = item.of(width)
    hit = np.isin(hashes, own)
    order = np.lexsort((places[hit], hashes[hit]))
    hashes, places = hashes[hit][order], places[hit][order]
    bounds: dict[int, list[int]] = {}
    tiles = []
    for h, j in zip(own.tolist(), at.tolist()):
        if not item.free[j : j + width].all():
            continue
        if h not in bounds:
            bounds[h] = [int(np.searchsorted(hashes, np.uint64(h), side)) for side in ("left", "right")]
        start, end = bounds[h]
        k = start
        while k < end:
            i = int(places[k])
            taken = np.flatnonzero(~doc.free[i : i + width])
            if len(taken):  # as are all places before the end of it
                ahead = max(1, int(np.searchsorted(places[k : min(end, k + width)], i + int(taken[-1]) + 1)))
                start = start + ahead if start == k else start
                k += ahead
            elif np.array_equal(doc.ids[i : i + width], item.ids[j : j + width]):
                doc.free[i : i + width] = False
                item.free[j : j + width] = False
                tiles.append((i, j, width))
                break
            else:
                k += 1
        bounds[h][0] = start
    return tiles


def tile(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Tiles (doc word, item word, length), longest first.

    Ids below zero match nothing. Equal lengths are marked in the order of the
    item's, then the document's words. The longest common run of free words is
    found by running Karp-Rabin over windows whose width is halved; each run is
    compared word by word before it is marked.
    """
    left, right = Windows(doc), Windows(item)
    tiles: list[tuple[int, int, int]] = []
    most = min(len(item), len(doc))
    while most >= least:
        low, high = least - 1, most
        while low < high:
            width = (low + high + 1) // 2
            if np.isin(right.of(width)[0], left.of(width)[0]).any():
                low = width
            else:
                high = width - 1
        if low < least:
            break
        found = _mark(left, right, low)
        tiles += found
        # Nothing of that width is left; without a true run, equal hashes misled.
        most = low if found else low - 1
    return tiles


class Index:
    """Benchmark items by the hashes of their seeds."""

    def __init__(self, items: list[tuple[int, str]], least: int):
        self.vocabulary: dict[str, int] = {}
        self.items: list[tuple[int, np.ndarray]] = []
        posts: dict[int, list[tuple[np.ndarray, int]]] = defaultdict(list)
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)]
            if ids:
                width = min(least, len(ids))
                posts[width].append((rolling(np.array(ids, dtype=np.int64), width), len(self.items)))
                self.items.append((item_id, np.array(ids, dtype=np.int64)))
        #: By width: sorted seed hashes, and for each the item and the place in it.
        self.seeds = {}
        for width, rows in posts.items():
            hashes = np.concatenate([h for h, _ in rows])
            number = np.concatenate([np.full(len(h), i) for h, i in rows])
            place = np.concatenate([np.arange(len(h)) for h, _ in rows])
            order = np.argsort(hashes, kind="stable")
            self.seeds[width] = hashes[order], number[order], place[order]

    def shared(self, doc: np.ndarray, coverage: float) -> Iterator[tuple[int, int, np.ndarray]]:
        """(width, item number, document places) where shared seeds may cover enough of the item.

        Each distinct seed of the document is looked up once, so a repeated one
        costs its places, not their product with those in the items.
        """
        for width, (hashes, number, place) in self.seeds.items():
            if len(doc) < width:
                continue
            known = np.concatenate([[0], np.cumsum(doc < 0)])
            at = np.flatnonzero(known[width:] == known[:-width])
            own = rolling(doc, width)[at]
            lo = np.searchsorted(hashes, own, "left")
            hit = hashes[np.minimum(lo, len(hashes) - 1)] == own
            if not hit.any():
                continue
            at, own = at[hit], own[hit]
            order = np.argsort(own, kind="stable")
            seeds, first = np.unique(own[order], return_index=True)
            last = np.append(first[1:], len(own))
            lo, hi = np.searchsorted(hashes, seeds, "left"), np.searchsorted(hashes, seeds, "right")
            seed = np.repeat(np.arange(len(seeds)), hi - lo)
            post = np.arange(len(seed)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)
            by_item = np.argsort(number[post], kind="stable")
            for group in np.split(by_item, np.flatnonzero(np.diff(number[post[by_item]])) + 1):
                item = int(number[post[group[0]]])
                covered = np.count_nonzero(_cover(place[post[group]], width, len(self.items[item][1])))
                if covered >= coverage * len(self.items[item][1]):  # tiles lie on shared seeds only
                    used = np.unique(seed[group])
                    yield width, item, at[np.concatenate([order[first[u] : last[u]] for u in used.tolist()])]

    def leaks(self, text: str | None, coverage: float):
        """(item id, item words, tiles) of every item that the text leaks."""
        get = self.vocabulary.get
        words = words_of(text)
        doc = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        del words
        for width, number, doc_at in self.shared(doc, coverage):
            item_id, item = self.items[number]
            on_seed = np.flatnonzero(_cover(doc_at, width, len(doc)))
            # A gap between seeds becomes one word that matches nothing.
            gaps = np.flatnonzero(np.diff(on_seed) > 1) + 1
            part = np.insert(doc[on_seed], gaps, -1)
            back = np.insert(on_seed, gaps, -1)
            tiles = [(int(back[i]), j, n) for i, j, n in tile(part, item, width)]
            if sum(n for _, _, n in tiles) >= coverage * len(item):
                yield item_id, len(item), tiles


def _cover(places: np.ndarray, width: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in a window that starts at one of the places."""
    edge = np.zeros(size + 1, dtype=np.int64)
    np.add.at(edge, places, 1)
    np.add.at(edge, places + width, -1)
    return np.cumsum(edge[:-1]) > 0


_indexes: dict[int, Index] = {}


def _index(key: int, items: list[tuple[int, str]], least: int) -> Index:
    """One index per worker and block, built where it is first needed."""
    if key not in _indexes:
        _indexes.clear()
        _indexes[key] = Index(items, least)
    return _indexes[key]


def _blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """Items of bounded total length; an item by itself may be longer."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).filter("text IS NOT NULL")
    total = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    for i in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i)
        yield sorted(((r[0], r[1]) for r in block.collect()), key=lambda r: (r[0] is None, r))


def _each_block(docs: DataFrame, benchmark: DataFrame, least: int, block_chars: int, run: Callable) -> Iterator:
    for items in _blocks(benchmark, block_chars):
        key = hash((tuple(items), least))
        yield lambda batches, items=items, key=key: run(batches, _index(key, items, least))


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    least: int = MIN_MATCH,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per document and item it leaks, with its tiles.

    An item of fewer than ``least`` words is leaked if its whole text occurs.
    Items without a word and missing texts leak nothing; repeated documents or
    items give a row each; an empty table on either side gives no rows. Places
    and lengths of tiles are in words.
    """

    def run(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("doc_id", pa.int64()), ("item_id", pa.int64()), ("item_words", pa.int64()), ("tiled_words", pa.int64()),
             ("coverage", pa.float64()), ("n_tiles", pa.int64()),
             ("tiles", pa.list_(pa.struct([("doc_word", pa.int64()), ("item_word", pa.int64()), ("words", pa.int64())])))]
        )
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for item_id, n, tiles in index.leaks(text, coverage):
                    tiled = sum(t[2] for t in tiles)
                    named = [dict(zip(("doc_word", "item_word", "words"), t)) for t in sorted(tiles)]
                    rows.append(dict(zip(schema.names, (doc_id, item_id, n, tiled, tiled / n, len(tiles), named))))
            yield pa.RecordBatch.from_pylist(rows, schema)

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    result = None
    for block in _each_block(docs, benchmark, least, block_chars, run):
        found = narrow.mapInArrow(block, LEAK)
        result = found if result is None else result.union(found)
    return result


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    least: int = MIN_MATCH,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``docs`` without the rows that leak an item; no shuffle, columns as they are.

    Rows without a text stay, repeated rows stay or go together, and an empty
    benchmark takes nothing away.
    """
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            clean = [next(index.leaks(t, coverage), None) is None for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(clean, pa.bool_()))

    for block in _each_block(docs, benchmark, least, block_chars, run):
        docs = docs.mapInArrow(block, docs.schema)
    return docs
