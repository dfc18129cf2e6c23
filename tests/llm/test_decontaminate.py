"""Greedy string tiling against its definition, and leaks against all pairs."""

import time
import tracemalloc

import numpy as np
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from saleswright.llm import decontaminate as dc
from saleswright.llm.decontaminate import Windows, decontaminate, find_leaks, rolling, tile, words_of
from saleswright.llm.queries import queries


def plain_tiling(doc, item, least):
    """Mark the longest common free runs until none of ``least`` words is left."""
    free_doc, free_item = [d >= 0 for d in doc], [True] * len(item)
    lengths = []
    while True:
        best, runs = least - 1, []
        for j in range(len(item)):
            for i in range(len(doc)):
                n = 0
                while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n] and free_doc[i + n] and free_item[j + n]:
                    n += 1
                if n > best:
                    best, runs = n, [(j, i)]
                elif n == best and n >= least:
                    runs.append((j, i))
        if best < least:
            return sorted(lengths)
        for j, i in runs:
            if all(free_doc[i : i + best]) and all(free_item[j : j + best]):
                free_doc[i : i + best] = [False] * best
                free_item[j : j + best] = [False] * best
                lengths.append((i, j, best))


words = st.lists(st.integers(0, 3), max_size=30)


@settings(max_examples=200, deadline=None)
@given(words, words, st.integers(2, 5))
def test_tiling_is_greedy(doc, item, least):
    got = tile(np.array(doc, dtype=np.int64), np.array(item, dtype=np.int64), least)
    assert sorted(got) == plain_tiling(doc, item, least)


def test_windows_of_any_width():
    ids = np.array([3, 1, 4, 1, -1, 9, 4, 1, 4, 1], dtype=np.int64)
    hashes, places = Windows(ids).of(3)
    assert places.tolist() == [0, 1, 5, 6, 7]
    assert hashes[1] == hashes[4] and len(set(hashes.tolist())) == 4
    assert len(Windows(ids).of(11)[0]) == 0


def test_equal_hashes_do_not_mislead(monkeypatch):
    """With a base of one, windows of the same words in any order collide."""
    monkeypatch.setattr(dc, "_BASE", np.uint64(1))
    monkeypatch.setattr(dc, "_INVERSE", np.uint64(1))
    random = np.random.default_rng(0)
    for _ in range(60):
        doc, item = random.integers(0, 3, 25), random.integers(0, 3, 14)
        assert sorted(tile(doc, item, 3)) == plain_tiling(doc.tolist(), item.tolist(), 3)


HOSTILE = {
    "one word": (" ".join(["again"] * 200), " ".join(["again"] * 1_000_000)),
    "two words": ("to be " * 100, "to be " * 500_000),
    "many items": (" ".join(f"w{i}" for i in range(400)), " ".join(f"w{i % 400}" for i in range(800_000))),
}


@pytest.mark.parametrize("name", HOSTILE)
def test_long_repeated_texts(name):
    """A million repeated words: seconds, and memory in proportion to the text."""
    item, text = HOSTILE[name]
    index = dc.Index([(i, item) for i in range(3)], 5)
    began = time.time()
    tracemalloc.start()
    found = list(index.leaks(text, 0.8))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(n, sum(t[2] for t in tiles)) for _, n, tiles in found] == [(len(item.split()),) * 2] * 3
    assert time.time() - began < 30 and peak < 500e6


def test_rolling_hash_equals_window_by_window():
    ids = np.array([3, 1, 4, 1, 5, 9, 2, 6], dtype=np.int64)
    windows = [int(rolling(ids[i : i + 3], 3)[0]) for i in range(6)]
    assert rolling(ids, 3).tolist() == windows
    assert len(rolling(ids, 9)) == 0


def test_query_equals_all_pairs(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()
    expected = set()
    for d in docs:
        doc = words_of(d.text)
        grams = {tuple(doc[i : i + 5]) for i in range(len(doc) - 4)}
        for b in items:
            item = words_of(b.text)
            if grams & {tuple(item[i : i + 5]) for i in range(len(item) - 4)}:
                names = {w: i for i, w in enumerate(dict.fromkeys(item))}
                ids = [names.get(w, -1) for w in doc]
                tiled = sum(n for _, _, n in plain_tiling(ids, [names[w] for w in item], 5))
                if tiled >= 0.8 * len(item):
                    expected.add((d.doc_id, b.item_id, tiled))
    got = queries()["op2_decontaminate"](spark, SF_SMALL).collect()
    assert {(r.doc_id, r.item_id, r.tiled_words) for r in got} == expected
    assert expected


ITEM = " ".join(f"w{i}" for i in range(30))
HALVES = " ".join(f"w{i}" for i in range(15, 30)) + " filler words " + " ".join(f"w{i}" for i in range(15))


@pytest.fixture
def benchmark(spark):
    rows = [(1, ITEM), (2, "Two words"), (3, None), (4, ""), (5, "..."), (1, ITEM)]
    return spark.createDataFrame(rows, "item_id long, text string")


def leaks(spark, benchmark, texts, **options):
    docs = spark.createDataFrame([(i, t, 9) for i, t in enumerate(texts)], "doc_id long, text string, item_id long")
    found = [(r.doc_id, r.item_id) for r in find_leaks(docs, benchmark, **options).collect()]
    kept = [r.doc_id for r in decontaminate(docs, benchmark, **options).collect()]
    assert set(kept) == set(range(len(texts))) - {d for d, _ in found}
    assert decontaminate(docs, benchmark, **options).columns == docs.columns
    return sorted(found)


def test_cases(spark, benchmark):
    texts = [None, "", ITEM.upper() + "!", HALVES, " ".join(ITEM.split()[:20]), "x two, words y", "two other words"]
    texts.append(("### " + ITEM + " ") * 300)
    expected = [(2, 1), (2, 1), (3, 1), (3, 1), (5, 2), (7, 1), (7, 1)]
    assert leaks(spark, benchmark, texts) == expected
    assert leaks(spark, benchmark, texts, block_chars=40) == expected


def test_empty_tables(spark, benchmark):
    docs = spark.createDataFrame([(1, ITEM)], "doc_id long, text string")
    assert find_leaks(docs.limit(0), benchmark).collect() == []
    assert find_leaks(docs, benchmark.limit(0)).collect() == []
    assert decontaminate(docs, benchmark.limit(0)).count() == 1
