"""Near-duplicates by SimHash, found by meet-in-the-middle ball hashing.

Two fingerprints at most two bits apart share a variant that is one flip away
from each. The third bit is taken by leaving a block out: of three bits in
which two fingerprints differ, at least one lies in one of three blocks, and in
what remains they differ in two at most. So every distinct fingerprint emits,
for each block left out, the rest of its bits and all their one-flip variants:
132 rows, a fixed number. Rows with equal variants meet in one task after a
shuffle and are compared bit by bit. Copies have met before that, as equal
fingerprints, so the rows of a variant are distinct fingerprints only, whatever
share of the documents a group of copies holds. No pairs are put out: a
variant's verified links are reduced to a spanning forest on the spot.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fixed, fresh, slices
from .components import components, forest

SHINGLE = 3
SEED = 42
MAX_BITS = 3
#: First bit and number of bits of the blocks, one of which is left out.
BLOCKS = ((0, 21), (21, 21), (42, 22))
_CHUNK = 200_000
#: Fingerprints of a variant beyond which only those that agree in parts are compared.
MANY = 4096
#: Most rows (of two numbers) that are broadcast.
FEW = 500_000


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """SimHash over the hashes of all word shingles, repeats included.

    A-Z are lowered; words are what ASCII blanks separate. Fewer words than
    ``width`` make one shingle, no word at all makes zero. A bit is set if it
    is in more than half of the hashes.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < width:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = (np.concatenate([[0], ends[:-1] + 1])[: len(words) - width + 1]).tolist()
    ends = ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), _CHUNK):
        pairs = zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK])
        hashes = np.array([digest(joined[a:b], SEED) for a, b in pairs], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """``doc_id, text_hash, fp`` (the fingerprint as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([fingerprint(t, width) for t in batch.column(2).to_pylist()], dtype=np.uint64)
            columns = [batch.column(0), batch.column(1), pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "fp"])

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def variants(fps: DataFrame) -> DataFrame:
    """``block, key, fp``: for each block left out, the rest and its one-flip variants."""
    keys = []
    for block, (first, size) in enumerate(BLOCKS):
        left_out = ((1 << size) - 1) << first
        keep = np.array(~left_out & (2**64 - 1), dtype=np.uint64).view(np.int64).item()
        flips = [0] + [1 << i for i in range(64) if not left_out >> i & 1]
        flips = [f - 2**64 if f >= 2**63 else f for f in flips]
        masks = F.array(*[F.lit(f).cast("long") for f in flips])
        rest = F.col("fp").bitwiseAND(F.lit(keep).cast("long"))
        keys.append(F.struct(F.lit(block).alias("block"), rest.alias("rest"), masks.alias("masks")))
    return (
        fps.select("fp", F.inline(F.array(*keys)))
        .select("fp", "block", "rest", F.explode("masks").alias("mask"))
        .select("block", F.col("rest").bitwiseXOR(F.col("mask")).alias("key"), "fp")
    )


def _forest(fps: np.ndarray, rest: np.ndarray, key: np.uint64, bits: int) -> list[tuple[int, int]]:
    """Links enough to connect, among fingerprints of one variant, all that are close.

    Pairs equal outside the block share all their variants; they count only
    where the variant is their own value.
    """
    if len(fps) == 2:
        a, b = fps.tolist()
        counts = rest[0] != rest[1] or rest[0] == key
        return [(a, b)] if counts and (a ^ b).bit_count() <= bits else []
    links: list[tuple[int, int]] = []
    root = np.arange(len(fps))
    for i in range(1, len(fps)):
        apart = np.bitwise_count(fps[:i] ^ fps[i])
        close = (apart <= bits) & ((rest[:i] != rest[i]) | (rest[i] == key))
        for r in np.unique(root[:i][close]):
            j = int(np.flatnonzero(close & (root[:i] == r))[0])
            links.append((int(fps[j]), int(fps[i])))
        joined = np.unique(root[:i][close])
        if len(joined):
            root[: i + 1][np.isin(root[: i + 1], joined)] = i
    return links


def _large_forest(fps: np.ndarray, rest: np.ndarray, key: np.uint64, bits: int, block: int) -> list[tuple[int, int]]:
    """``_forest`` for a run of many: only fingerprints that agree in half of the left-out block are compared.

    The block is cut into twice as many parts as bits may differ, so two that
    are close agree in ``bits`` of them at least; each choice is looked at.
    """
    first, size = BLOCKS[block]
    edges = [first + size * k // (2 * bits) for k in range(2 * bits + 1)]
    parts = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:])]
    n = len(fps)
    to, at = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    for chosen in combinations(parts, bits):
        agreed = fps & np.uint64(sum(chosen))
        order = np.argsort(agreed, kind="stable")
        # Places of one group lie together: compare each with the one k further on.
        k, left = 1, np.flatnonzero(agreed[order][1:] == agreed[order][:-1])
        while len(left):
            i, j = order[left], order[left + k]
            close = (np.bitwise_count(fps[i] ^ fps[j]) <= bits) & ((rest[i] != rest[j]) | (rest[i] == key))
            to, at = np.concatenate([to, i[close]]), np.concatenate([at, j[close]])
            if len(to) > 4 * n:
                to, at = forest(to, at, n)
            k += 1
            left = left[left + k < n]
            left = left[agreed[order[left]] == agreed[order[left + k]]]
    to, at = forest(to, at, n)
    return list(zip(fps[to].tolist(), fps[at].tolist()))


def _verify(bits: int):
    keeps = np.array([~(((1 << n) - 1) << first) & (2**64 - 1) for first, n in BLOCKS], dtype=np.uint64)

    def meet(block: np.ndarray, key: np.ndarray, fp: np.ndarray) -> list[tuple[int, int]]:
        """Links within the runs of equal (block, key) of sorted rows."""
        edge = np.flatnonzero((block[1:] != block[:-1]) | (key[1:] != key[:-1])) + 1
        bounds = np.concatenate([[0], edge, [len(key)]])
        size = np.diff(bounds)
        links: list[tuple[int, int]] = []
        for at, n in zip(bounds[:-1][size > 1].tolist(), size[size > 1].tolist()):
            run = fp[at : at + n]
            if n > MANY and bits:
                links += _large_forest(run, run & keeps[block[at]], key[at], bits, int(block[at]))
            else:
                links += _forest(run, run & keeps[block[at]], key[at], bits)
        return links

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.empty(0, np.int32), np.empty(0, np.uint64), np.empty(0, np.uint64)]

        def out(links: list[tuple[int, int]]) -> pa.RecordBatch:
            ends = np.array(links, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            new = [batch.column(0).to_numpy(), *(batch.column(i).to_numpy().view(np.uint64) for i in (1, 2))]
            block, key, fp = (np.concatenate(x) for x in zip(kept, new))
            # The last run may go on in the next batch.
            other = np.flatnonzero((block != block[-1]) | (key != key[-1]))
            cut = int(other[-1]) + 1 if len(other) else 0
            yield out(meet(block[:cut], key[:cut], fp[:cut]) if cut else [])
            kept = [block[cut:], key[cut:], fp[cut:]]
        if len(kept[0]):
            yield out(meet(*kept))

    return run


def links(fps: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """``a, b``: pairs that connect all distinct ``fp`` at most ``bits`` (3 at most) apart."""
    if not 0 <= bits <= 3:
        raise ValueError("balls of half the radius are built for up to three bits")
    met = variants(fps).repartition("block", "key").sortWithinPartitions("block", "key")
    return met.mapInArrow(_verify(bits), "a long, b long")


def near_duplicates(docs: DataFrame, width: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, text_hash, fp, component_id, kept_hash`` of every row.

    Rows are linked when their fingerprints differ in at most ``bits`` bits, and
    a component holds all that links reach; its id is the smallest ``doc_id`` in
    it (null if all are missing), and ``kept_hash`` the smallest hash of a text
    that has this id. Missing and empty texts have fingerprint zero and are
    linked like any other. Repeated rows fall into one component. An empty table
    gives no rows.
    """
    fps = fixed(fingerprints(docs, width))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    own = fixed(fps.groupBy("fp").agg(first.alias("least")))
    roots = components(links(own.select("fp"), bits)).withColumnRenamed("node", "fp")
    by_fp = own.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    by_root = by_fp.groupBy("root").agg(F.min("least").alias("first"))
    labels = by_fp.select("fp", "root").join(by_root, "root")
    component = [F.col("first.doc_id").alias("component_id"), F.col("first.text_hash").alias("kept_hash")]
    return fps.join(labels.select("fp", *component), "fp").select("doc_id", "text_hash", "fp", "component_id", "kept_hash")


def keep_one(docs: DataFrame, width: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that of the smallest id.

    Of rows with equal ids, or none, the text with the smallest hash stays, and
    of wholly repeated rows one. Columns stay as they are. The rows to drop are
    broadcast if they have been counted to be few, and otherwise shuffled.
    """
    found = near_duplicates(docs, width, bits)
    here = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("kept_hash"))
    counted = fixed(found.groupBy("doc_id", "text_hash", here.alias("kept")).count())
    name = fresh(docs, "_dropped")
    dropped = counted.filter("NOT kept").select(F.col("doc_id").alias(name), F.col("text_hash").alias(f"{name}_hash"))
    if dropped.count() <= FEW:
        dropped = F.broadcast(dropped)
    text_hash = F.xxhash64(F.col("text").cast("string"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(name)) & (text_hash == F.col(f"{name}_hash"))
    result = docs.join(dropped, same, "left_anti")
    if counted.filter("kept AND count > 1").isEmpty():
        return result
    return result.withColumn(name, text_hash).dropDuplicates(["doc_id", name]).drop(name)
