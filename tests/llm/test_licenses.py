"""Licences: cosines by plain dictionaries, inheritance folder by folder."""

import math
import re
from collections import Counter

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from saleswright.llm import licenses as lic
from saleswright.llm.queries import queries


def folded(text):
    return " ".join(re.findall(lic.TERM, text.lower()))


def plain_scores(passages, windows=()):
    """Best (licence, cosine) of each passage or window, by dense dictionaries; passages weigh."""
    templates = [(name, folded(b)) for name, bodies in lic.TEMPLATES.items() for b in bodies]
    df = Counter(t for text in [*passages, *(b for _, b in templates)] for t in set(text.split()))
    n = len(passages) + len(templates)

    def vector(text):
        counts = Counter(text.split())
        return {t: (1 + math.log(c)) * (math.log((1 + n) / (1 + df[t])) + 1) for t, c in counts.items()}

    def cosine(a, b):
        norms = math.sqrt(sum(x * x for x in a.values())) * math.sqrt(sum(x * x for x in b.values()))
        return sum(x * b.get(t, 0) for t, x in a.items()) / norms

    known = [(name, vector(b)) for name, b in templates]
    out = {}
    for p in {*passages, *windows}:
        own = vector(p)
        far, name = min((-round(cosine(own, b), 6), name) for name, b in known)
        if -far >= lic.LEAST:
            out[p] = (name, -far)
    return out


def speaking(text):
    """Whole lines, paragraphs and sentences."""
    paragraphs = re.split(r"\n[ \t\r]*\n", text)
    sentences = [s for p in paragraphs for s in re.split(r"(?<=[.!?;])\s+", p, flags=re.A)]
    units = {folded(x) for x in [*text.split("\n"), *paragraphs, *sentences]}
    return {u for u in units if re.search(lic.KEY, u)}


def around(text):
    """Windows of every template's length that hold a key word or phrase."""
    out = set()
    for paragraph in re.split(r"\n[ \t\r]*\n", text):
        words = folded(paragraph).split()
        for n in {len(folded(b).split()) for bodies in lic.TEMPLATES.values() for b in bodies}:
            for at in range(max(1, len(words) - n + 1)):
                if re.search(lic.KEY, window := " ".join(words[at : at + n])):
                    out.add(window)
    return out


def plain_scan(files):
    texts = {text or "" for _, text in files}
    passages = {t: speaking(t) for t in texts}
    windows = {t: around(t) for t in texts if re.search(lic.KEY, folded(t))}
    scored = plain_scores(sorted(set().union(*passages.values())), set().union(*windows.values()))

    def own(text):
        found = [(-scored[p][1], scored[p][0]) for p in passages[text or ""] | windows.get(text or "", set()) if p in scored]
        return min(found) if found else None

    given = {}
    for path, text in files:
        mine = own(text)
        if mine and re.search(lic.LICENSE_FILE, path or ""):
            folder = (path or "").rpartition("/")[0]
            given[folder] = min(mine, given.get(folder, mine))
    for path, text in files:
        mine = own(text)
        folder = (path or "").rpartition("/")[0]
        if mine:
            yield path, mine[1], "own", None
            continue
        while folder not in given and folder:
            folder = folder.rpartition("/")[0]
        found = given.get(folder)
        yield path, found and found[1], "inherited" if found else "none", folder if found else None


def scan(spark, files):
    df = spark.createDataFrame(files, "path string, text string").selectExpr("*", "7 AS passage", "'x' AS _own", "1 AS license")
    got = lic.scan_licenses(df).collect()
    assert all(r.passage == 7 and r["_own"] == "x" for r in got)
    return sorted(map(str, ((r.path, r.license, r.origin, r.folder) for r in got)))


FILES = [
    ("LICENSE", "Released under the MIT License."),
    ("a.py", "x = 1"),
    ("lib/COPYING.txt", "# This work is licensed under the GNU General Public License, version 3."),
    ("lib/b/c/d.py", "no word of it"),
    ("lib/b/e.py", "// Licensed under the Apache License, Version 2.0.\ncode();"),
    ("lib/b/f.py", "LICENSED!! UNDER### CC&&& BY-NC*** 4.0.%%%"),
    ("lib/b/LICENSE-MIT", "nothing said"),
    ("lib/two/LICENSE.a", "Licensed under the ISC License."),
    ("lib/two/LICENSE.b", "Licensed under CC0 1.0."),
    ("lib/two/g.py", None),
    ("library/h.py", "licensed to whom it may concern, at the end of the day, by some authority or other"),
    (None, "plain"),
    ("", ""),
    ("lib/b/c/d.py", "no word of it"),
]


def test_cases(spark):
    expected = sorted(map(str, plain_scan(FILES)))
    assert scan(spark, FILES) == expected
    assert "('lib/b/c/d.py', 'GPL-3.0', 'inherited', 'lib')" in expected
    assert "('lib/b/f.py', 'CC-BY-NC-4.0', 'own', None)" in expected
    assert "('library/h.py', 'MIT', 'inherited', '')" in expected


def test_long_line_is_read_to_its_end(spark):
    text = "word " * 200_000 + "Licensed under the Mozilla Public License, Version 2.0."
    got = lic.scan_licenses(spark.createDataFrame([("a", text), ("b", "word " * 200_000)], "path string, text string"))
    assert {r.path for r in got.collect()} == {"a", "b"}
    around = spark.createDataFrame([(text,)], "text string").select(lic.passages(F.col("text")))
    assert any("mozilla public license" in p for p in around.first()[0])


def test_empty_table(spark):
    assert lic.scan_licenses(spark.createDataFrame([], "path string, text string")).collect() == []


def test_query(spark):
    rows = queries()["op8_licenses"](spark, SF_SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    expected = sorted(map(str, plain_scan([(r.path, texts[r.doc_id]) for r in rows])))
    assert sorted(map(str, ((r.path, r.license, r.origin, r.folder) for r in rows))) == expected
    assert sorted(r.doc_id for r in rows) == sorted(texts)


@pytest.mark.parametrize("name", lic.TEMPLATES)
def test_templates_find_themselves(name):
    for body in lic.TEMPLATES[name]:
        assert re.search(lic.KEY, body)
        assert plain_scores([folded(body)])[folded(body)][0] == name


def test_licence_amid_other_text(spark):
    """Long and mixed lines, wrapped grants and paragraphs of any length."""
    grant = lic.TEMPLATES["MIT"][3]
    at = [i for i, c in enumerate(grant) if c == " "]
    wrapped = "".join("\n * " if i in at[5::9] else c for i, c in enumerate(grant))
    prose = [f"word{i % 97} and some text" for i in range(400)]
    files = [
        ("wrapped", "\n".join([*prose, wrapped, *prose])),
        ("long line", " ".join([*prose, "Licensed under the Mozilla Public License, Version 2.0.", *prose])),
        ("mixed line", f"{' '.join(prose[:20])}. Licensed under the ISC License. {' '.join(prose[:20])}"),
        ("wrapped key", " ".join(prose).replace(" ", "\n") + "\n" + lic.TEMPLATES["BSD-3-Clause"][1].replace(" ", "\n# ")),
        ("none", " ".join([*prose, "my licence to drive", *prose])),
    ]
    assert all(len(text) > 6000 for name, text in files if name != "mixed line")
    got = {r.path: r.license for r in lic.scan_licenses(spark.createDataFrame(files, "path string, text string")).collect()}
    assert got == {"wrapped": "MIT", "long line": "MPL-2.0", "mixed line": "ISC", "wrapped key": "BSD-3-Clause", "none": None}


@pytest.mark.parametrize("n", [58, 59, 60, 5990, 6010, 60_000])
def test_no_length_decides(spark, n):
    """A title line in a line, sentence and paragraph of any length."""
    filler = " ".join(f"w{i % 53}" for i in range(n))
    files = [("line", f"{filler} Licensed under the ISC License. {filler}"), ("wrapped", f"{filler}\nReleased under the\nMIT License.\n{filler}")]
    got = {r.path: r.license for r in lic.scan_licenses(spark.createDataFrame(files, "path string, text string")).collect()}
    assert got == {"line": "ISC", "wrapped": "MIT"}


def test_every_window_with_a_key_word_lies_in_a_stretch():
    words = [("license" if i in (40, 300, 420) or 900 < i < 1300 else "".join(chr(97 + int(c)) for c in str(i))) for i in range(1500)]
    found = lic.stretches(" ".join(words))
    assert all(len(w.split()) <= lic.STRETCH for w in found)
    for size in lic._LENGTHS:
        for at in range(len(words) - size + 1):
            window = words[at : at + size]
            if "license" in window:
                assert any(f" {' '.join(window)} " in f" {w} " for w in found)
