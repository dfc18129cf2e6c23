"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns several virtual nodes on a ring of ``2 ** CELL_BITS`` cells. A
row hashes to a cell and belongs to the next node clockwise. A shard takes rows
up to its capacity; what a full shard cannot take continues clockwise to the
next node whose shard has room, so balance is guaranteed, and a change in the
number of shards moves few rows besides those the new capacities force.

Only the number of rows per cell reaches the driver: 65,536 numbers at any
input size. There the overflow is walked once around the ring, which yields, for
each cell, which ranks within the cell go to which shard and slot. The rows
themselves are ranked per cell on the executors and looked up in that table.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fixed, text_or_empty

CELL_BITS = 16
NODES = 128


def ring(shards: int, nodes: int = NODES) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, clockwise."""

    def cell(shard: int, node: int) -> int:
        digest = hashlib.blake2b(f"shard {shard} node {node}".encode(), digest_size=8).digest()
        return int.from_bytes(digest, "big") >> (64 - CELL_BITS)

    return sorted((cell(s, v), s) for s in range(shards) for v in range(nodes))


def capacities(rows: int, shards: int, load: float) -> list[int]:
    """Most rows per shard: at ``load`` 1 counts end at most one apart."""
    if load <= 1:
        return [rows // shards + (s < rows % shards) for s in range(shards)]
    return [int(np.ceil(load * rows / shards))] * shards


def walk(counts: np.ndarray, nodes: list[tuple[int, int]], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(cell, first rank, end rank, shard, first slot), covering every row once.

    Each shard first takes the rows of its own arcs, in ring order; the rest
    then travels clockwise.
    """
    room, used = list(room), [0] * len(room)
    starts = [c for c, _ in nodes]
    own: list[list[int]] = [[] for _ in nodes]  # cells of each node's arc
    for cell in np.flatnonzero(counts):
        own[bisect_right(starts, int(cell) - 1) % len(nodes)].append(int(cell))
    placed: list[tuple[int, int, int, int, int]] = []

    def take(shard: int, cell: int, lo: int, hi: int) -> int:
        n = min(hi - lo, room[shard])
        if n:
            placed.append((cell, lo, lo + n, shard, used[shard]))
            used[shard] += n
            room[shard] -= n
        return lo + n

    left: list[list[tuple[int, int, int]]] = [[] for _ in nodes]
    for i, (_, shard) in enumerate(nodes):
        for cell in own[i]:
            n = int(counts[cell])
            if (lo := take(shard, cell, 0, n)) < n:
                left[i].append((cell, lo, n))
    carried: deque[tuple[int, int, int]] = deque()
    for i in [*range(len(nodes)), *range(len(nodes))]:
        shard = nodes[i][1]
        while carried and room[shard]:
            cell, lo, hi = carried.popleft()
            if (lo := take(shard, cell, lo, hi)) < hi:
                carried.appendleft((cell, lo, hi))
        carried.extend(left[i])
        left[i] = []
    assert not carried, "capacities are below the number of rows"
    return placed


def assign_shards(docs: DataFrame, shards: int = 16, load: float = 1.0, nodes: int = NODES) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row of ``docs``.

    ``size`` is the UTF-8 bytes of the text plus 1. ``slot`` counts a shard's
    rows from 0 without gaps. The place on the ring comes from id and text, so
    equal ids (or missing ones) do not meet in one cell unless the texts are
    equal too; ties within a cell are broken by id, checksum and size, and fully
    equal rows get different slots. A missing text counts as empty. ``load`` is
    the bound on a shard's rows over the mean; 1 means counts at most one apart.
    An empty table gives no rows.
    """
    spark = docs.sparkSession
    text = text_or_empty(F.col("text"))
    crc = F.crc32(text.cast("binary"))
    rows = fixed(
        docs.select(
            "doc_id",
            (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
            crc.alias("text_crc32"),
            F.xxhash64(F.col("doc_id"), crc).alias("place"),
        ).withColumn("cell", F.shiftrightunsigned("place", 64 - CELL_BITS).cast("int"))
    )
    counts = np.zeros(1 << CELL_BITS, dtype=np.int64)
    for cell, n in rows.groupBy("cell").count().collect():  # at most 2 ** CELL_BITS rows
        counts[cell] = n
    placed = walk(counts, ring(shards, nodes), capacities(int(counts.sum()), shards, load))
    cells, lo, hi, shard, slot = (np.array(x, dtype=np.int64) for x in (zip(*placed) if placed else [()] * 5))
    targets = spark.createDataFrame(
        pa.table({"cell": cells.astype(np.int32), "_lo": lo, "_hi": hi, "shard": shard.astype(np.int32), "_slot": slot})
    )
    in_cell = Window.partitionBy("cell").orderBy("place", "doc_id", "text_crc32", "size")
    ranked = rows.withColumn("_rank", F.row_number().over(in_cell).cast("long") - 1)
    fits = (F.col("_rank") >= F.col("_lo")) & (F.col("_rank") < F.col("_hi"))
    return (
        ranked.join(F.broadcast(targets.withColumnRenamed("cell", "_cell")), (F.col("cell") == F.col("_cell")) & fits)
        .select("doc_id", "size", "text_crc32", "shard", (F.col("_slot") + F.col("_rank") - F.col("_lo")).alias("slot"))
    )
