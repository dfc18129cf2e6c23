"""Quality rules: counts by definition, thresholds by exact quantiles."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saleswright.llm import quality as q
from saleswright.llm.queries import queries

BLANK = " \t\n\x0b\x0c\r"


def plain_counts(text):
    text = text or ""
    words, word = [], ""
    for c in text + " ":
        if c in BLANK:
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if line.strip(BLANK):
            repeats += line in seen
            seen.add(line)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, repeats, len(inside)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab#é \n\t\x0b\x85 "), max_size=60))
def test_counts(text):
    assert q.count_text(text)[:5] == plain_counts(text)


def verdicts(rows):
    """The rule over exact quantiles instead of sketches."""
    groups = {"source": defaultdict(list), "lang": defaultdict(list), "all": defaultdict(list)}
    for r in rows:
        groups["source"][r.lang, r.source].append(r)
        groups["lang"][r.lang].append(r)
        groups["all"][()].append(r)
    fences = {}
    for level, by_key in groups.items():
        for key, own in by_key.items():
            if len(own) >= q.MIN_ROWS or level == "all":
                for m in q.RATIOS:
                    values = sorted(r[m] for r in own)
                    low, mid, up = (values[int(np.ceil(p * len(values) - 1e-9)) - 1] for p in (1 - q.UPPER, 0.5, q.UPPER))
                    fences[level, key, m] = low - q.REACH * (mid - low), up + q.REACH * (up - mid), mid, up
    for r in rows:
        sure, inside = True, True
        for m in q.RATIOS:
            keys = (("source", (r.lang, r.source)), ("lang", r.lang), ("all", ()))
            low, high, mid, up = next(fences[(*k, m)] for k in keys if (*k, m) in fences)
            if m == "word_length":
                off = mid / np.sqrt(max(1, r.n_words))
            else:
                n = max(1, {"capitals": r.word_chars, "dup_lines": r.n_lines}.get(m, r.n_words)) / (6 if m == "repeats" else 1)
                p = min(up, 1)
                off = 2 * np.sqrt(p * (1 - p) / n) + 4 / (n + 4)
            inside &= r[m] <= high + off and (r[m] >= low - off or m != "word_length")
            sure &= min(abs(r[m] - high - off), abs(r[m] - low + off)) > 0.06 * max(abs(high), abs(low))
        yield r, inside, sure


def test_query(spark):
    lines = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike("[^ \t-\r]")))
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", lines.alias("n_lines"))
    rows = queries()["op1_quality"](spark, SF_SMALL).join(docs, "doc_id").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        n_words, *_, repeats = expected = plain_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (n_words < 50 or 100 * repeats > 50 * n_words)
        assert not (r.base_failed and r.kept)
    checked = [(r, inside) for r, inside, sure in verdicts(rows) if sure]
    assert len(checked) > 0.8 * len(rows)
    assert all(r.kept == (inside and not r.base_failed) for r, inside in checked)


def test_labels_agree(spark):
    labels = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/labels.parquet")
    rows = queries()["op1_quality"](spark, SF_SMALL.replace("0.001", "0.01")).join(labels, "doc_id").collect()
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    assert sum(r.kept for r in bad) <= 0.02 * len(bad)


def test_sources_differ(spark):
    """What is normal in one source is out of range in another."""
    words = [f"word{i:03d}" for i in range(80)]
    plain = " ".join(words)
    table = " | ".join(words)
    rows = [(i, plain, "en", "prose") for i in range(150)] + [(200 + i, table, "en", "tables") for i in range(150)]
    rows += [(500, table, "en", "prose"), (501, table, "en", "tables"), (502, table, "xx", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in q.quality(docs.selectExpr("*", "9 AS n_words", "'x' AS symbols")).collect()}
    assert not kept[500] and kept[501] and kept[0] and kept[200]


def test_reach_follows_spread(spark):
    """A source that varies more gets a wider range; one that never varies, none but chance."""
    random = np.random.default_rng(1)
    words = [f"word{i:04d}" for i in range(2000)]

    def text(share):
        return " ".join(w + "#" * int(random.random() < share) for w in random.choice(words, 400, replace=False))

    shares = {"none": lambda: 0.0, "some": lambda: random.uniform(0.1, 0.2), "wide": lambda: random.uniform(0.0, 0.6)}
    rows = [(None, text(share()), "en", source) for source, share in shares.items() for _ in range(200)]
    rows += [(k, text(share), "en", source) for source in shares for k, share in ((1, 0.03), (2, 0.4), (3, 0.7))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    measured = q.measure(docs)
    high = {r.source: r.s_symbols.high for r in q.fences(q.quantiles(q.sketches(measured), "lang", "source"), "s", "lang", "source").collect()}
    assert high["none"] == 0 < 0.2 < high["some"] < 0.5 < 0.8 < high["wide"]
    kept = {(r.source, r.doc_id): r.kept for r in q.judge(measured).filter("doc_id IS NOT NULL").collect()}
    assert kept == {(s, k): (s, k) in {("some", 1), ("wide", 1), ("wide", 2), ("wide", 3)} for s in shares for k in (1, 2, 3)}


def test_ranges_of_the_documents_differ(spark):
    """In the supplied documents, most groups have a reach of their own in some ratio."""
    docs = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.1')}/documents.parquet")
    found = q.fences(q.quantiles(q.sketches(q.measure(docs)), "lang", "source"), "s", "lang", "source").collect()
    reach = {
        m: [round(r[f"s_{m}"].high - r[f"s_{m}"].middle, 6) for r in found] for m in ("capitals", "word_length", "repeats")
    }
    assert len(found) > 10 and len(set(zip(*reach.values()))) > 0.9 * len(found)
    assert max(reach["capitals"]) > 1.5 * min(reach["capitals"]) > 0


@pytest.fixture
def odd(spark):
    rows = [(None, None, None, None), (1, "", "en", "s"), (1, "", "en", "s"), (2, "a " * 300_000, None, "s"), (3, "\n" * 1000, "en", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_odd_rows(odd):
    rows = q.quality(odd).collect()
    assert len(rows) == 5
    assert all(r.base_failed and r.kept is False for r in rows)
    assert q.quality(odd.limit(0)).collect() == []


def test_sketches_merge(spark):
    """Two halves added up are the whole, and quantiles are right to half a percent."""
    values = np.random.default_rng(2).lognormal(0, 2, 4000)
    rows = [("en", f"s{i % 2}", *[float(v)] * 5) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "lang string, source string, " + ", ".join(f"{m} double" for m in q.RATIOS))
    found = q.quantiles(q.merge(q.sketches(df))).filter("measure = 'symbols'").first()
    assert found.rows == 4000
    for share, got in ((0.15, found.lower), (0.5, found.middle), (0.85, found.upper)):
        exact = np.sort(values)[int(np.ceil(share * 4000 - 1e-6)) - 1]
        assert abs(got - exact) <= 0.003 * exact
