"""HTML extraction: blocks, the chain's sums and decoding, held-out pages."""

import html
import itertools
import re
import time
import tracemalloc

import numpy as np
import pytest
from conftest import SF_SMALL

from saleswright.llm import html_text as h
from saleswright.llm.queries import queries

SF = SF_SMALL.replace("0.001", "0.01")


def article(page):
    """The article element of the supplied pages, block by block."""
    inner = re.search("<article>(.*?)(?:</article>|$)", page, re.S)[1]
    cut = re.sub("<[^>]*(?:>|$)", "\n\n", inner.replace("<b>", "").replace("<br>", " "))
    return "\n\n".join(" ".join(html.unescape(p).split()) for p in cut.split("\n\n") if p.split())


def test_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries()["op9_html"](spark, SF).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    right = 0
    for r in rows:
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url
        right += r.text == article(pages[r.page_id].html)
    assert right >= 0.99 * len(rows)


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        (None, []),
        ("", []),
        ("just  text\n here", ["just text here"]),
        ("<p>a<br>b<p>c &amp; d &#233;&nbsp;e</p>f", ["a b", "c & d é e", "f"]),
        ("<p>a <b>b <i>c</p>d", ["a b c", "d"]),
        ('<p title="a > b">x</p><script>if (a < "</p>") {}</script>y', ["x", "y"]),
        ("<ul><li>a<li>b<ul><li>c</ul>d</ul>e", ["a", "b", "c", "d", "e"]),
        ("<!-- <p>no</p> --><p>a</p><!-- open", ["a"]),
        ("<p>cut off &am", ["cut off &am"]),
        ("<p>cut off <stro", ["cut off"]),
        ('<p>a</p><div class="x', ["a"]),
        ("1 < 2 <p>3 > 2</div>", ["1 < 2", "3 > 2"]),
        ("<STYLE>p{}</STYLE><P>a</P><textarea>form</textarea><title>t</title>", ["a"]),
        ("<script>never closed <p>a", []),
    ],
)
def test_blocks(page, texts):
    assert [b.text for b in h.blocks(page)] == texts


def test_paths_and_links():
    found = h.blocks('<div class="side-bar" role="main"><p>a<a href=x>bcd</a></p></div><p>e')
    assert found[0].path == (("div", ("side", "bar", "role:main")), ("p", ()))
    assert found[0].linked == 3 and found[1].path == (("p", ()),)


def test_sums_and_decoding_by_enumeration():
    rng = np.random.default_rng(0)
    steps = rng.normal(size=(2, 2))
    for n in (1, 2, 5):
        emit = rng.normal(size=n)

        def score(labels):
            return sum(e for e, y in zip(emit, labels) if y) + sum(steps[a, b] for a, b in zip(labels, labels[1:]))

        every = list(itertools.product((0, 1), repeat=n))
        weight = np.exp([score(y) for y in every])
        weight /= weight.sum()
        padded = np.concatenate([emit, rng.normal(size=3)])[None, :]
        p, pairs, total = h._sums(padded, steps, np.array([n]))
        assert p[0, :n] == pytest.approx([sum(w for w, y in zip(weight, every) if y[t]) for t in range(n)])
        assert total[0] == pytest.approx(np.log(sum(np.exp(score(y)) for y in every)))
        for a, b in itertools.product((0, 1), repeat=2):
            expected = sum(w * sum((x, z) == (a, b) for x, z in zip(y, y[1:])) for w, y in zip(weight, every))
            assert pairs[a, b] == pytest.approx(expected)
        chain = h.Chain({str(i): e for i, e in enumerate(emit.tolist())}, tuple(map(tuple, steps.tolist())))
        assert tuple(chain.decode([[str(i)] for i in range(n)])) == max(every, key=score)


@pytest.fixture(scope="module")
def chain(spark):
    return h.train(spark.read.parquet(f"{SF}/pages.parquet"))


def test_pages_laid_out_anew(chain):
    """Layouts the chain has not seen with these texts: nearly all blocks right."""
    texts = [f"A sentence number {i}, with a few more words in it and an end." for i in range(50)]
    pages = h.made_pages(texts, ["Home", "More"], 150, seed=77)
    hits = [a == bool(b) for rows, labels in pages for a, b in zip(chain.decode(rows), labels)]
    assert np.mean(hits) >= 0.97


def test_parts_around_an_article(chain):
    body = "".join(f"<p>Paragraph {i} says something, and then it says a bit more of it.</p>" for i in range(5))
    page = (
        "<header><p>The site of all sites</p></header><nav><ul><li><a href=/>Home</a></li></ul></nav>"
        '<div class="cookie-notice"><p>We use cookies to improve this site.</p><button>Accept</button></div>'
        f'<main><article><h1>Title here</h1>{body}<div class="ad">Buy this now, it is good.</div></article></main>'
        '<aside class="sidebar"><h3>Related</h3><ul><li><a href=/a>Other story</a></li></ul></aside>'
        '<section id="comments"><h2>Comments</h2><div class="comment"><p>I do not agree with it, sorry.</p></div></section>'
        "<form><label>Search this site</label></form><footer>&copy; all rights reserved</footer>"
    )
    expected = ["Title here", *(f"Paragraph {i} says something, and then it says a bit more of it." for i in range(5))]
    assert h.main_text(page, chain) == "\n\n".join(expected)


def test_odd_rows(spark, chain):
    long = "<article>" + "<p>Some words of a paragraph, with a stop.</p>" * 20_000
    rows = [(None, None, None), (1, "u", ""), (1, "u", ""), (2, None, "<"), (3, "u", long), (4, "u", "<a \"'" * 2000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'t' AS text", "1 AS n_chars")
    got = h.extract(pages, chain).collect()
    assert [r.page_id for r in got] == [None, 1, 1, 2, 3, 4]
    assert [r.text for r in got[:3]] == ["", "", ""]
    assert got[4].text.count("\n\n") == 19_999
    assert h.extract(pages.limit(0), chain).collect() == []


def test_training_on_an_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert h.train(pages, made=30).weights


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        ('<p>a <svg width="1"/> b</p><p>c</p>', ["a b", "c"]),
        ("<p>a <math/> b</p><p>c <math><mi>x</mi><mo>=</mo><mn>1</mn></math> d</p>", ["a b", "c x=1 d"]),
        ('<p>a</p><object data="x"/><p>b</p><object data="y"><p>instead</p>', ["a", "b", "instead"]),
        ('<p>a <object data="x">instead</object> b</p>', ["a instead b"]),
        ("<p>a <svg><path d='M0'><p>b</p>c", ["a", "b", "c"]),
        ("<p>a <svg><title/><style/><text>t</text></svg> b</p><p>c", ["a t b", "c"]),
        ("<p>a <svg><title>icon</svg> b</p><svg><title>two</title></svg>c", ["a b", "c"]),
    ],
)
def test_drawings_formulas_and_objects_amid_an_article(page, texts):
    assert [b.text for b in h.blocks(page)] == texts


N = 100_000
HOSTILE = {
    "nested": ("<div>x" * N, N),
    "nested with names": ("".join(f"<section class='n{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}'>x" for i in range(N)), N),
    "nested quotes": ("<blockquote>" * N + "x" + "</blockquote>" * N, 1),
    "lists": ("<ul><li>x" * N, N),
    "paragraphs in no end": ("<p>x</em></p></div></ul>" * N, N),
    "drawings with titles": ("<svg><title>" * N + "x", 1),
    "drawings and titles that end": ("<p><svg><title>t</title><math></svg>x" * N, N),
    "drawings in drawings": ("<svg>" * N + "x" + "</svg></math>" * N, 1),
    "titles": ("<title>" * N + "x", 0),
    "links": ("<a href='x'>" * N + "x", 1),
    "open quotes": ("<p class='x>" * N, None),
}


@pytest.mark.parametrize("name", HOSTILE)
def test_hostile_pages(chain, name):
    """Seconds and memory in proportion to the page, however deep or open its elements."""
    page, expected = HOSTILE[name]
    began = time.time()
    found = h.blocks(page)
    assert len(chain.label(found)) == len(found)
    assert time.time() - began < 10
    assert expected is None or len(found) == expected
    tracemalloc.start()  # slow, so on a tenth
    chain.label(h.blocks(page[: len(page) // 10]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50e6


def test_carried_sums_equal_whole_features(chain, spark):
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").limit(40).collect()]
    rng = np.random.default_rng(3)
    pages += [h.make_page(rng, ["One text.", "Another text of it."], ["Home"]).replace(h._SIGN, "") for _ in range(40)]
    for page in pages:
        found = h.blocks(page)
        assert chain.label(found) == chain.decode(h.features(found))
        for b, names in zip(found, h.features(found)):
            above = {f"in:{t}" for t, _ in b.path} | {f"named:{n}" for _, own in b.path for n in own}
            assert sorted(n for n in names if n.startswith(("in:", "named:"))) == sorted(above)


def test_svg_text_is_marked():
    found = h.blocks("<p>a b c d e f <svg><text>g</text></svg></p><svg><text>label</text></svg><p>plain <math><mi>x</mi></math><p><svg/>plain")
    marks = [[f for f in row if f.startswith("svg:")] for row in h.features(found)]
    assert [bool(m) for m in marks] == [True, True, False, False] and marks[0] != marks[1]


def test_wording_of_a_long_block_is_read_to_its_end():
    page = "<p>" + "word " * 500 + "Subscribe to our newsletter.</p>"
    assert {"sign:subscribe", "sign:newsletter"} <= set(h.features(h.blocks(page))[0])
