"""Personal data against the patterns applied one match at a time."""

import hashlib
import re

import pytest
from conftest import SF_SMALL

from saleswright.llm.pii import find_pii
from saleswright.llm.queries import queries

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def holds(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def brute(text):
    return {
        kind: [m.span() for m in re.finditer(pattern, text or "") if kind == "email" or holds(kind, m[0])]
        for kind, pattern in BASE.items()
    }


def digest(found):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k in BASE for a, b in found[k]).encode()).hexdigest()


def test_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = queries()["op7_pii"](spark, SF_SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        found = brute(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(found[k]) for k in BASE]
        assert r.base_sha256 == digest(found)
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) > 10


ODD = [
    None,
    "",
    "a@b.c@d.e x.y@q.r_x@y.z @x.y z@",
    "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.255 1.2.3.256",
    "4111 1111 1111 1111, 4111-1111-1111-1111x4111111111111112",
    "+1 (017) 555-7713 ++49 30 1234567) +1 +12345678901234567",
    "\ufdd0 marks \ufdd0 me@x.org \ufdd2 \U0001f600 you@x.org",
    "a" * 3_000,
    "1" * 3_000 + "@",
    "a.b@" * 500,
    "10.0.0.1 " * 2_000,
    "x@" + "y." * 5_000 + "z",
]


def test_odd_texts(spark):
    df = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(ODD)], "doc_id long, text string, _pii_scan string")
    rows = {r.doc_id: r for r in find_pii(df).collect()}
    for i, text in enumerate(ODD):
        spans = [s for s in rows[i].pii if s.kind in BASE]
        assert {k: [(s.start, s.end) for s in spans if s.kind == k] for k in BASE} == brute(text)
        assert all(text[s.start : s.end] == s.value.replace("\ufdd2", "\ufdd0") for s in rows[i].pii)
        assert rows[i]["_pii_scan"] == "kept"


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        ("IBAN DE89 3704 0044 0532 0130 00 please", ["iban"]),
        ("iban DE89370400440532013001", []),
        ("card 378282246310005", ["short_card"]),
        ("order 378282246310005", []),
        ("ssn 123-45-6789", ["national_id"]),
        ("part 123-45-6789", []),
        ("ssn 000-45-6789", []),
    ],
)
def test_extra_kinds_need_checksum_or_context(spark, text, kinds):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [s.kind for s in find_pii(df).first().pii] == kinds


def test_context_moves_the_score(spark):
    texts = ["call +1 (017) 555-7713", "xx +1 (017) 555-7713", "invoice +1 (017) 555-7713"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    scores = [r.pii[0].score for r in find_pii(df).collect()]
    assert scores == [0.8, 0.6, 0.4]


def test_no_python_no_shuffle(spark, plan):
    text = plan(queries()["op7_pii"](spark, SF_SMALL))
    assert "Python" not in text and "Arrow" not in text and "Exchange" not in text


def test_very_long_texts(spark):
    """Runs and repeats that would make a backtracking pattern take hours."""
    texts = ["a" * 500_000, "1" * 500_000 + "@", "a.b@" * 50_000, "10.0.0.1 " * 20_000, "x@" + "y." * 100_000 + "z"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: len(r.pii) for r in find_pii(df).collect()}
    assert found == {0: 0, 1: 0, 2: 25_000, 3: 20_000, 4: 1}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert find_pii(df).collect() == []
