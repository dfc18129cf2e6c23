"""Near-duplicates against all pairs of fingerprints."""

import random
import re
import time

import numpy as np
import xxhash
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from saleswright.llm import simhash
from saleswright.llm.components import components
from saleswright.llm.queries import queries
from saleswright.llm.simhash import fingerprint, keep_one, links, near_duplicates


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", lowered) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, edges):
    """Smallest node reachable, by a plain walk."""
    near = {n: set() for n in nodes}
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for n in sorted(nodes):
        todo = [n]
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = n
                todo += near[x]
    return out


def plain_components(rows):
    """Smallest id by row, over all pairs of distinct fingerprints."""
    fps = {fp for _, fp in rows}
    pairs = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3]
    root = roots(fps, pairs)
    least = {}
    for doc_id, fp in rows:
        if doc_id is not None:
            least[root[fp]] = min(doc_id, least.get(root[fp], doc_id))
    return [(doc_id, fp, least.get(root[fp])) for doc_id, fp in rows]


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aBcÉé \n\x85"), max_size=40))
def test_fingerprint(text):
    assert fingerprint(text) == plain_fingerprint(text)


def test_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    rows = queries()["op5_simhash"](spark, SF_SMALL).collect()
    expected = plain_components([(d.doc_id, plain_fingerprint(d.text)) for d in docs])
    got = [(r.doc_id, int(r.fingerprint, 16), r.component_id) for r in rows]
    assert sorted(got) == sorted(expected)
    assert all(len(r.fingerprint) == 16 for r in rows)


def flipped(fp, *bits):
    for b in bits:
        fp ^= 1 << b
    return fp


def test_links_find_every_close_pair(spark):
    """Chains, stars and pairs at every distance, in and across the blocks."""
    rng = random.Random(4)
    fps = {0, 2**64 - 1, 1 << 63}
    for _ in range(60):
        base = rng.getrandbits(64)
        fps |= {base, *(flipped(base, *rng.sample(range(64), d)) for d in (1, 2, 3, 3, 3, 4, 5))}
    hub = rng.getrandbits(64)
    fps |= {flipped(hub, i, j) for i in range(0, 64, 3) for j in range(0, 64, 5)}  # one large group
    fps |= {flipped(hub, i, j, k) for i, j, k in ((0, 1, 2), (0, 21, 42), (20, 21, 63), (41, 42, 43))}
    signed = [(f - 2**64 if f >= 2**63 else f,) for f in fps]
    found = links(spark.createDataFrame(signed, "fp long").repartition(7)).collect()
    got = [(r.a % 2**64, r.b % 2**64) for r in found]
    assert all((a ^ b).bit_count() <= 3 for a, b in got)
    close = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3]
    assert roots(fps, got) == roots(fps, close)
    assert {frozenset(p) for p in got} <= {frozenset(p) for p in close}


def test_large_runs_are_split_without_loss():
    """Comparing only what agrees in half the block connects what comparing all does."""
    rng = np.random.default_rng(6)
    for block, (first, size) in enumerate(simhash.BLOCKS):
        left_out = ((1 << size) - 1) << first
        outside = int(rng.integers(2**63)) & ~left_out & (2**64 - 1)
        near = [outside | (int(x) << first) for x in rng.integers(0, 1 << size, 300)]
        near += [flipped(near[k % 100], *(first + rng.permutation(size)[: 1 + k % 3]).tolist()) for k in range(200)]
        near += [flipped(f, (first + size + 5) % 64) for f in near[:150]]
        fps = np.array(sorted(set(near)), dtype=np.uint64)
        rest = fps & np.uint64(~left_out & (2**64 - 1))
        for bits in (1, 2, 3):
            for key in (outside, flipped(outside, (first + size + 5) % 64)):
                whole = simhash._forest(fps, rest, np.uint64(key), bits)
                split = simhash._large_forest(fps, rest, np.uint64(key), bits, block)
                nodes = set(fps.tolist())
                assert whole and roots(nodes, split) == roots(nodes, whole)


def test_a_large_run_takes_seconds():
    fps = np.arange(60_000, dtype=np.uint64) * np.uint64(35)
    rest = fps & np.uint64(2**64 - 2**21)
    began = time.time()
    assert len(simhash._large_forest(fps, rest, np.uint64(0), 3, 0)) <= len(fps)
    assert time.time() - began < 60


def test_odd_rows(spark):
    long = "word other thing " * 30_000
    rows = [(None, None), (5, ""), (7, " \n"), (9, "one two"), (8, "ONE  two"), (3, long), (2, long), (2, long), (None, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 AS fp", "'d' AS _dropped")
    got = [(r.doc_id, r.fp % 2**64, r.component_id) for r in near_duplicates(docs).collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(plain_components([(i, plain_fingerprint(t)) for i, t in rows]), key=key)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=key) == sorted(
        [(5, ""), (8, "ONE  two"), (2, long), (None, "alone")], key=key
    )
    assert near_duplicates(docs.limit(0)).collect() == []
    assert keep_one(docs.limit(0)).collect() == []


def test_components_of_long_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(100, 400)]
    star = [(7, i) for i in range(1000, 1300)]
    edges = chain + star + [(50, 50)]
    nodes = {n for e in chain + star for n in e}
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == roots(nodes, chain + star)
