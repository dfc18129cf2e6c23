"""Periodic runs of words: Lyndon arrays by Baier's grouping, roots extended into runs.

A run is a stretch with smallest period q that no neighbour extends. Each run
holds roots that are longest Lyndon words at their places under an order of the
words or under its reverse, so two Lyndon arrays name every root. Phase one of
Baier's suffix sorter gives such an array by itself: suffixes are grouped by
their first word, groups are taken from the greatest down, and each member
lengthens the context of the nearest suffix before it that lies in a lower
group. When a group's turn comes, its context is the longest Lyndon word of its
members. A root is then extended both ways as far as words one period apart
agree.

Runs are wanted from four periods on. In such a run every window of three words
occurs three times, so words outside stretches where that holds take no part in
the sorting; nothing is lost by this, however long the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

#: Least length of a run in words, and in periods (three windows of three words need four).
MIN_LENGTH = 6
MIN_PERIODS = 4

RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def lyndon_array(ranks: list[int]) -> list[int]:
    """Length of the longest Lyndon word at each place, by grouping alone.

    ``ranks`` may be any integers; the empty suffix counts as the least.
    """
    n = len(ranks)
    number = {r: k for k, r in enumerate(sorted(set(ranks)))}
    group = [number[r] for r in ranks]
    top = len(number) - 1
    members: list[list[int]] = [[] for _ in number]
    for i, g in enumerate(group):
        members[g].append(i)
    context = [1] * len(number)
    below = list(range(-1, top))
    above = list(range(1, top + 2))
    # Places of this and greater groups point to the left, by one place more than their own.
    left = list(range(n + 1))
    found = [0] * n
    g = top
    while g >= 0:
        size = context[g]
        here = [i for i in members[g] if group[i] == g]
        for i in here:
            found[i] = size
            left[i + 1] = i
        times: dict[int, int] = {}
        for i in here:
            while left[i] != i:
                left[i] = i = left[left[i]]
            if i:
                times[i - 1] = times.get(i - 1, 0) + 1
        new: dict[tuple[int, int], int] = {}
        # Most times first, as each new group is put right above the old one.
        for j, t in sorted(times.items(), key=itemgetter(1), reverse=True):
            old = group[j]
            to = new.get((old, t))
            if to is None:
                to = new[old, t] = len(members)
                members.append([])
                context.append(context[old] + t * size)
                up = above[old]
                below.append(old)
                above.append(up)
                above[old] = below[up] = to
            group[j] = to
            members[to].append(j)
        members[g] = here[:0]
        g = below[g]
    return found


def agree_right(words: np.ndarray, a: int, b: int) -> int:
    """How many words from ``a`` on equal those from ``b`` on, for ``a < b``."""
    k, step, n = 0, 32, len(words)
    while b + k < n:
        m = min(step, n - b - k)
        other = words[a + k : a + k + m] != words[b + k : b + k + m]
        at = int(other.argmax())
        if other[at]:
            return k + at
        k, step = k + m, 2 * step
    return k


def agree_left(words: np.ndarray, a: int, b: int) -> int:
    """How many words before ``a`` equal those before ``b``, for ``a < b``."""
    k, step = 0, 32
    while a - k > 0:
        m = min(step, a - k)
        other = (words[a - k - m : a - k] != words[b - k - m : b - k])[::-1]
        at = int(other.argmax())
        if other[at]:
            return k + at
        k, step = k + m, 2 * step
    return k


def _runs_of(words: np.ndarray, min_length: int, min_periods: int) -> set[tuple[int, int, int]]:
    """Runs of a stretch by Lyndon roots under both orders."""
    out: set[tuple[int, int, int]] = set()
    place = np.arange(len(words))
    for ranks in (words, -words):
        period = np.array(lyndon_array(ranks.tolist()), dtype=np.int64)
        # Four periods hold three equal roots in a row.
        far = np.flatnonzero(place + 3 * period <= len(words))
        p = period[far]
        alike = (period[far + p] == p) & (period[far + 2 * p] == p)
        alike &= (words[far + p] == words[far]) & (words[far + 2 * p] == words[far])
        ends: dict[int, int] = {}
        for i, q in zip(far[alike].tolist(), p[alike].tolist()):
            if i + q <= ends.get(q, 0):  # a root of the stretch found before
                continue
            start = i - agree_left(words, i, i + q)
            end = ends[q] = i + q + agree_right(words, i, i + q)
            if end - start >= max(min_length, min_periods * q):
                out.add((start, end - start, q))
    return out


def _stretches(words: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of stretches in which every window of three words occurs three times."""
    todo = [(0, len(words))]
    while todo:
        first, last = todo.pop()
        part = words[first:last]
        if len(part) < MIN_LENGTH:
            continue
        base = int(part.max()) + 1
        pair = part[:-2] * base + part[1:-1]
        if base > 2_000_000:  # else three numbers fit into one
            pair = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        window = pair * base + part[2:]
        ordered = np.sort(window)
        thrice = ordered[2:][ordered[2:] == ordered[:-2]]
        if not len(thrice):
            continue
        hit = thrice[np.minimum(np.searchsorted(thrice, window), len(thrice) - 1)] == window
        edge = np.zeros(len(part) + 1, dtype=np.int64)
        at = np.flatnonzero(hit)
        edge[at] += 1
        edge[at + 3] -= 1
        inside = np.cumsum(edge)[:-1] > 0
        if inside.all():
            yield first, last
            continue
        bounds = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
        todo += [(first + a, first + b) for a, b in bounds.reshape(-1, 2).tolist()]


def text_runs(
    words: list[bytes], min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS
) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of a text, by start, then period."""
    if min_length < MIN_LENGTH or min_periods < MIN_PERIODS:
        raise ValueError(f"runs are found from {MIN_LENGTH} words and {MIN_PERIODS} periods on")
    if len(words) < min_length:
        return []
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    if len(numbers) == len(words):
        return []
    out: set[tuple[int, int, int]] = set()
    for first, last in _stretches(ids):
        found = _runs_of(ids[first:last], min_length, min_periods)
        out.update((first + start, length, q) for start, length, q in found)
    return sorted(out, key=lambda run: (run[0], run[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside runs and of each run's first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), dtype=bool)
    for start, length, q in runs:
        kept[start + q : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(kept).tolist()])


def _scan(min_length: int, min_periods: int) -> Callable:
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_words", pa.int64()),
            ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
            ("collapsed", pa.string()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts, found, short = [], [], []
            for text in batch.column(1).to_pylist():
                words = (text or "").encode("utf-8", "surrogatepass").split()
                runs = text_runs(words, min_length, min_periods)
                counts.append(len(words))
                found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                short.append(collapse(words, runs).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, f.type) for c, f in zip((counts, found, short), list(schema)[1:]))],
                schema=schema,
            )

    return run


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row.

    Words are what ASCII blanks separate, numbered from 0. ``runs`` are ordered
    by start, then period; ``collapsed`` is the text without what runs repeat. A
    missing or empty text has no words, no runs and an empty ``collapsed``. Rows
    are looked at one by one: repeated ids or rows stay, other columns do not
    matter, and an empty table gives no rows. No row is moved, so a hot source
    or group of copies costs what its texts cost.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scan(min_length, min_periods), RUNS)
