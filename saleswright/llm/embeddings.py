"""Near-duplicate embeddings by int8 tile products with rigorous error bounds.

Every vector is brought to length one and rounded to 8-bit steps of its own
size. What rounding takes away is measured, so a product of rounded vectors
tells their cosine up to a bound that holds for each pair. Products of a tile
of vectors with another are one matrix product over small integers, which single
precision carries without error. Most pairs are decided by it: below the
threshold for certain, or above it for certain. Vectors with a pair in between
are looked at again in full precision, tile by tile.

Equal vectors are counted once beforehand. The others are dealt at random into
blocks, and each pair of blocks is a group of its own, so a group of near copies
is spread over all of them, whatever its share. Only sums per vector and a
spanning forest per pair of tiles are put out, no pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fixed
from .components import components, forest

THRESHOLD = 0.9
#: Blocks at least, for tasks enough, and most vectors of a block, for memory.
BLOCKS = 16
BLOCK_ROWS = 500_000
#: Vectors of a tile, and dimensions whose products of bytes single precision sums exactly.
TILE = 1024
_EXACT = 1024
#: What sums in double precision can be off by, far above its rounding.
_SLACK = 1e-9


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows in double precision at length one; the largest component first guards the squares."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def quantise(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Steps from -127 to 127, the size of a step, and the length of what rounding took."""
    size = np.abs(units).max(axis=1) / 127
    steps = np.rint(units / size[:, None])
    off = units - steps * size[:, None]
    return steps.astype(np.int8), size, np.sqrt(np.einsum("ij,ij->i", off, off))


def _vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and values of the usable vectors of a column, by dimension."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    for n in np.unique(lengths[lengths > 0]).tolist():
        at = np.flatnonzero(lengths == n)
        found = values[starts[at][:, None] + np.arange(n)]
        usable = np.isfinite(found).all(axis=1) & found.any(axis=1)
        yield at[usable], found[usable]


def _identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``vec_id``, a digest of the vector and the vector as doubles; null where it links with nothing."""
    for batch in batches:
        digests: list[bytes | None] = [None] * batch.num_rows
        raw: list[bytes | None] = [None] * batch.num_rows
        for at, found in _vectors(batch.column(1)):
            for i, row in zip(at.tolist(), found + 0.0):  # one zero, not two
                raw[i] = row.astype("<f8").tobytes()
                digests[i] = xxhash.xxh3_128_digest(raw[i])
        columns = [batch.column(0), pa.array(digests, pa.binary()), pa.array(raw, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["vec_id", "digest", "vector"])


def _rounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Steps, step size and error bound in place of each vector of ``number, n, vector``."""
    for batch in batches:
        raw = batch.column(2).to_pylist()
        steps: list[bytes] = [b""] * len(raw)
        size, off = np.zeros(len(raw)), np.zeros(len(raw))
        lengths = np.array([len(r) for r in raw])
        for n in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == n)
            found = np.frombuffer(b"".join([raw[i] for i in at.tolist()]), "<f8").reshape(len(at), -1)
            q, size[at], off[at] = quantise(unit(found))
            for i, row in zip(at.tolist(), q):
                steps[i] = row.tobytes()
        columns = [batch.column(0), batch.column(1), pa.array(steps, pa.binary()), pa.array(size), pa.array(off)]
        yield pa.RecordBatch.from_arrays(columns, ["number", "n", "steps", "size", "off"])


class Tile:
    """Some vectors of one dimension in their rounded form."""

    def __init__(self, steps: np.ndarray, size: np.ndarray, off: np.ndarray):
        self.steps, self.size, self.off = steps.astype(np.float32), size, off

    def verdict(self, other: Tile, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs are above the threshold for certain, and which may be.

        With x = x' + e and y = y' + f, the product x y is x' y' + x' f + e y,
        so it is off by at most (1 + |e|) |f| + |e|.
        """
        product = np.zeros((len(self.size), len(other.size)), dtype=np.float32)
        for at in range(0, self.steps.shape[1], _EXACT):
            part = self.steps[:, at : at + _EXACT] @ other.steps[:, at : at + _EXACT].T
            product = part if not at else product.astype(np.float64) + part
        # Pairs whose product is far off are set aside in single precision, with room to spare.
        most = self.off.max() + other.off.max() + self.off.max() * other.off.max()
        least = (threshold - most) * (1 - 1e-4) / (self.size.max() * other.size.max())
        row, column = np.nonzero(product >= (np.float32(least) if most < threshold else -np.inf))
        cosine = product[row, column].astype(np.float64) * self.size[row] * other.size[column]
        bound = self.off[row] + other.off[column] + self.off[row] * other.off[column] + _SLACK
        sure = cosine - bound >= threshold
        maybe = ~sure & (cosine + bound >= threshold)
        return np.stack([row[sure], column[sure]]), np.stack([row[maybe], column[maybe]])


class Side:
    """One block of a pair: numbers, counts of equal vectors and values."""

    def __init__(self, rows: pa.Table):
        self.number = rows.column("number").to_numpy()
        self.n = rows.column("n").to_numpy()
        self.steps = rows.column("steps").combine_chunks()
        self.size = rows.column("size").to_numpy()
        self.off = rows.column("off").to_numpy()
        lengths = np.array([len(s) for s in rows.column("steps").to_pylist()], dtype=np.int64)
        self.places = {d: np.flatnonzero(lengths == d) for d in np.unique(lengths).tolist()}

    def tiles(self, dimension: int) -> Iterator[tuple[np.ndarray, Tile]]:
        places = self.places.get(dimension, np.empty(0, np.int64))
        for at in range(0, len(places), TILE):
            here = places[at : at + TILE]
            raw = b"".join(self.steps.take(pa.array(here)).to_pylist())
            steps = np.frombuffer(raw, np.int8).reshape(len(here), dimension)
            yield here, Tile(steps, self.size[here], self.off[here])


def _compare(threshold: float, groups: int) -> Callable:
    """For a pair of blocks: links per vector, a forest of sure links, vectors to look at again."""

    def compare(rows: pa.Table) -> pa.Table:
        second = rows.column("second").to_numpy(zero_copy_only=False)
        pair = rows.column("pair")[0].as_py()
        left = Side(rows.filter(pa.array(~second)))
        right = left if pair // groups == pair % groups else Side(rows.filter(pa.array(second)))
        kinds, numbers, values = [], [], []

        def put(kind: int, number: np.ndarray, value: np.ndarray) -> None:
            kinds.append(np.full(len(number), kind, dtype=np.int32))
            numbers.append(number)
            values.append(value)

        links = [np.zeros(len(left.number), dtype=np.int64), np.zeros(len(right.number), dtype=np.int64)]
        again = [np.zeros(len(left.number), dtype=bool), np.zeros(len(right.number), dtype=bool)]
        for dimension in left.places:
            for x, a in left.tiles(dimension):
                for y, b in right.tiles(dimension):
                    if left is right and y[0] < x[0]:
                        continue
                    sure, maybe = a.verdict(b, threshold)
                    if left is right and x[0] == y[0]:  # a tile with itself: each pair once
                        sure, maybe = sure[:, sure[0] < sure[1]], maybe[:, maybe[0] < maybe[1]]
                    if sure.size:
                        _add(links, x[sure[0]], y[sure[1]], left.n, right.n)
                        names = np.concatenate([left.number[x], right.number[y]])
                        shift = 0 if left is right and x[0] == y[0] else len(x)
                        to, at = forest(sure[0], sure[1] + shift, len(names))
                        put(1, names[to], names[at])
                    again[0][x[maybe[0]]] = True
                    again[1][y[maybe[1]]] = True
        sides = [(left, 0)] if left is right else [(left, 0), (right, 1)]
        if left is right:
            links[0] += links[1]
            again[0] |= again[1]
        for side, k in sides:
            some = np.flatnonzero(links[k])
            put(0, side.number[some], links[k][some])
            # The pair of blocks, with the side in its last bit.
            some = np.flatnonzero(again[k])
            put(2, side.number[some], np.full(len(some), 2 * pair + k, dtype=np.int64))
        columns = [np.concatenate(c) if c else np.empty(0) for c in (kinds, numbers, values)]
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()))], ["kind", "number", "value"])

    return compare


def _add(links: list[np.ndarray], a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> None:
    np.add.at(links[0], a, n_b[b])
    np.add.at(links[1], b, n_a[a])


def _recompute(threshold: float) -> Callable:
    """The pairs that rounding left open, among vectors of a pair of blocks, in double precision."""

    def recompute(rows: pa.Table) -> pa.Table:
        second = rows.column("second").to_numpy(zero_copy_only=False)
        same = rows.column("same")[0].as_py()
        number, n = rows.column("number").to_numpy(), rows.column("n").to_numpy()
        raw = rows.column("vector").to_pylist()
        lengths = np.array([len(r) for r in raw])
        links = np.zeros(len(raw), dtype=np.int64)
        kinds, numbers, values = [], [], []
        for d in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == d)
            lefts, rights = at[~second[at]], at if same else at[second[at]]

            def tiles(places: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, Tile]]:
                for k in range(0, len(places), TILE):
                    here = places[k : k + TILE]
                    units = unit(np.frombuffer(b"".join([raw[i] for i in here.tolist()]), "<f8").reshape(len(here), -1))
                    yield here, units, Tile(*quantise(units))

            for x, ux, a in tiles(lefts):
                for y, uy, b in tiles(rights):
                    if same and y[0] < x[0]:
                        continue
                    _, (i, j) = a.verdict(b, threshold)
                    if same:
                        i, j = i[x[i] < y[j]], j[x[i] < y[j]]
                    close = np.empty(len(i), dtype=bool)
                    for k in range(0, len(i), 100_000):
                        part = slice(k, k + 100_000)
                        close[part] = np.einsum("ij,ij->i", ux[i[part]], uy[j[part]]) >= threshold
                    i, j = i[close], j[close]
                    np.add.at(links, x[i], n[y[j]])
                    np.add.at(links, y[j], n[x[i]])
                    to, leaf = forest(x[i], y[j], len(raw))
                    kinds.append(np.full(len(to), 1))
                    numbers.append(number[to])
                    values.append(number[leaf])
        some = np.flatnonzero(links)
        kinds.append(np.zeros(len(some)))
        numbers.append(number[some])
        values.append(links[some])
        columns = [np.concatenate(c).astype(np.int64) for c in (kinds, numbers, values)]
        return pa.table([pa.array(c, t, safe=False) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()))], ["kind", "number", "value"])

    return recompute


FOUND = "kind int, number long, value long"


def near_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, blocks: int = BLOCKS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Rows link when the cosine of their vectors, in double precision, is
    ``threshold`` (above 0) or more. ``n_links`` counts the other rows linked
    directly, ``component_id`` is the smallest id reachable, the row's own included, and
    ``kept`` tells whether that is its own. Vectors that are null, empty, zero
    or hold null or non-finite components link with nothing, and vectors of
    different dimensions not with each other. Repeated rows are rows of their
    own that link. A missing id is reached but never smallest; a component
    without any id has none and keeps no row. Other columns do not matter, and
    an empty table gives no rows.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    rows = vectors.select(F.col("vec_id").cast("long"), "embedding")
    rows = fixed(rows.mapInArrow(_identify, "vec_id long, digest binary, vector binary"))
    usable = rows.filter(F.col("digest").isNotNull())
    # Equal vectors are one from here on; the vector goes with its digest.
    grouped = usable.groupBy("digest", "vector").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first"))
    distinct = fixed(grouped.withColumn("number", F.monotonically_increasing_id()))
    groups = max(blocks, -(-distinct.count() // block_rows))
    block = F.pmod(F.xxhash64("number"), F.lit(groups)).cast("int")
    rounded = distinct.select("number", "n", "vector").mapInArrow(
        _rounded, "number long, n long, steps binary, size double, off double"
    )
    others = F.transform(
        F.sequence(F.lit(0), F.lit(groups - 1)),
        lambda x: F.struct(
            (F.least("block", x).cast("long") * groups + F.greatest("block", x)).alias("pair"), (F.col("block") > x).alias("second")
        ),
    )
    paired = rounded.withColumn("block", block).select("number", "n", "steps", "size", "off", F.inline(others))
    found = fixed(paired.groupBy("pair").applyInArrow(_compare(threshold, groups), FOUND))
    open_rows = found.filter("kind = 2").select(
        "number", F.expr("value div 2").alias("pair"), (F.col("value") % 2 == 1).alias("second")
    )
    same = (F.expr(f"pair div {groups}") == F.col("pair") % groups).alias("same")
    again = open_rows.join(distinct.select("number", "n", "vector"), "number").select("*", same)
    settled = fixed(again.groupBy("pair").applyInArrow(_recompute(threshold), FOUND))
    found = found.filter("kind < 2").union(settled)
    links = found.filter("kind = 0").groupBy("number").agg(F.sum("value").alias("links"))
    roots = components(found.filter("kind = 1").select(F.col("number").alias("a"), F.col("value").alias("b")))
    known = (
        distinct.select("digest", "number", "n", "first")
        .join(links, "number", "left")
        .join(roots.withColumnRenamed("node", "number"), "number", "left")
        .withColumn("root", F.coalesce("root", "number"))
    )
    known = fixed(known)
    firsts = known.groupBy("root").agg(F.min("first").alias("component_id"))
    known = known.join(firsts, "root").select(
        "digest", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    linked = usable.select("vec_id", "digest").join(known, "digest").drop("digest")
    alone = rows.filter(F.col("digest").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return linked.union(alone).withColumn("kept", kept)
