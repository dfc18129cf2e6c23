"""Runs of words against all stretches and periods, Lyndon arrays against all words."""

import hashlib
import random
import re
import time
import zlib
from fractions import Fraction

from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from saleswright.llm.queries import queries
from saleswright.llm.runs import find_runs, lyndon_array, text_runs


def plain_lyndon(w):
    def is_lyndon(x):
        return all(x < x[k:] for k in range(1, len(x)))

    return [max(n for n in range(1, len(w) - i + 1) if is_lyndon(w[i : i + n])) for i in range(len(w))]


def plain_runs(words):
    """For each period, maximal stretches; a smaller period of the same stretch wins."""
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(6, 4 * q):
                out.setdefault((i, length), q)
            i = j
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def words_of(doc_id, text):
    """The words that the query's contract looks at."""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def expected(doc_id, text, find=plain_runs):
    words = words_of(doc_id, text)
    runs = find(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        doc_id,
        len(runs),
        *(best or (None,) * 3),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(kept.encode()).hexdigest(),
    )


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=24))
def test_lyndon_array(w):
    assert lyndon_array(w) == plain_lyndon(w)
    assert lyndon_array([-x for x in w]) == plain_lyndon([-x for x in w])


@settings(max_examples=400, deadline=None)
@given(st.data())
def test_runs_of_words(data):
    parts = st.tuples(st.text("abc", min_size=1, max_size=6), st.integers(1, 12))
    text = "".join(part * k for part, k in data.draw(st.lists(parts, min_size=1, max_size=6)))
    words = [c.encode() for c in text]
    assert text_runs(words) == plain_runs(words)


def test_words_of_few_letters():
    """Fibonacci and Thue-Morse words, periods in periods, and a run cut by one word."""
    a, b = "b", "a"
    while len(b) < 1500:
        a, b = b, b + a
    morse = "".join("ab"[i.bit_count() % 2] for i in range(1024))
    nested = ("aaaaaab" * 5 + "c") * 5
    cut = "abcd" * 10 + "x" + "abcd" * 10
    for text in (b, morse, nested, cut, "a" * 5, "a" * 6, "ab" * 4, "ab" * 3 + "a", "abc" * 4, ("ab" * 30 + "ba" * 30) * 5):
        words = [c.encode() for c in text]
        assert text_runs(words) == plain_runs(words), text[:40]


def test_texts(spark):
    random.seed(5)
    words = [f"w{i}" for i in range(30)]
    texts = [None, "", " \n\t", "one", "a a a a a a", "é é é é é é ü", "a a " * 9, "x\x85 " * 7]
    texts += [" ".join(random.choices(words[: random.randint(1, 4)], k=random.randint(1, 90))) for _ in range(200)]
    texts += ["\n".join([" ".join(random.choices(words, k=random.randint(1, 9)))] * random.randint(1, 9)) for _ in range(100)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "a b " * 9, "x"), (3, "a b " * 9, "y"), (3, "a b " * 9, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = find_runs(docs).collect()
    assert len(got) == len(rows)
    for row, (doc_id, text, _) in zip(got, rows):
        words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
        runs = [(r.start, r.length, r.period) for r in row.runs]
        assert (row.doc_id, row.n_words, runs) == (doc_id, len(words), plain_runs(words))
    assert find_runs(docs.limit(0)).collect() == []


def test_query(spark, tmp_path):
    random.seed(9)
    words = [f"w{i}" for i in range(12)]
    rows = [(i, " ".join(random.choices(words, k=random.randint(0, 160)))) for i in range(600)]
    rows += [(None, "a b " * 9), (10, None), (11, ""), (12, "a b " * 9), (12, "a b " * 9)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries()["op13_runs"](spark, str(tmp_path)).select(*COLUMNS).collect()]
    want = [expected(*r) for r in rows]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert sum(w[1] > 0 for w in want) > 20


def test_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r) for r in queries()["op13_runs"](spark, SF_SMALL).select(*COLUMNS).collect()}
    assert got.keys() == docs.keys()
    short = [d for d, t in docs.items() if len((t or "").split()) <= 700]
    assert len(short) > 100
    for d in short:
        assert got[d] == expected(d, docs[d])


def test_long_texts():
    """A million words: one word, a long period, few letters at random, all different."""
    random.seed(2)
    n = 1_000_000
    root = [b"%d" % random.randrange(10**9) for _ in range(n // 5)]
    began = time.time()
    assert text_runs([b"a"] * n) == [(0, n, 1)]
    assert text_runs(root * 5) == [(0, n, n // 5)]
    assert text_runs([b"%d" % i for i in range(n)]) == []
    mixed = random.choices([b"a", b"b", b"c"], k=n // 5)
    assert all(length >= max(6, 4 * q) for _, length, q in text_runs(mixed))
    assert time.time() - began < 60
