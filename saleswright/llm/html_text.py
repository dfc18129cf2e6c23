"""Main text of web pages by a linear-chain conditional random field.

A page is read into its leaf blocks: runs of text between block elements, each
with the elements above it. Features of a block are its ancestors' tags, roles
and class or id words, and shape and wording of its text. The chain says for
every block whether it belongs to the article; weights are fitted here, in
numpy, by maximum likelihood with forward-backward sums, and a page is decoded
by Viterbi. Labelled pages for training come from a bounded sample of the
pages, labelled by their article elements, and from pages laid out anew in many
ways around texts of that sample, whose labels are known by construction.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sampled, slices

#: Bounds of the training sample: pages, blocks of each, characters and feature names of a block.
SAMPLE_PAGES, SAMPLE_BLOCKS, SAMPLE_CHARS, SAMPLE_NAMES = 400, 200, 400, 500
MADE_PAGES = 600

# HTML elements by what they do to text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav noscript ol p pre search "
    "section select summary table tbody td tfoot th thead tr ul option button".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = ("script", "style", "textarea", "title", "template", "iframe", "noframes")
FOREIGN_TAGS = ("svg", "math")
CLOSES_P = BLOCK_TAGS - {"option", "button", "legend", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"}
ONE_OF = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "option": ("option",), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",)}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+>|[^>]*(?:>|\Z))",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Words that tell boilerplate from articles.
SIGNS = frozenset(
    "cookie cookies accept privacy terms copyright rights reserved subscribe newsletter login register sign share tweet "
    "follow comment comments reply replies posted related read more next previous advertisement sponsored menu home "
    "contact about search email password submit".split()
)


# Elements that are never article text, by tag and by words of class and id.
_OUT_TAGS = {"nav", "aside", "footer", "form", "dialog", "button", "select"}
_OUT_NAMES = {"ad", "ads", "advert", "comment", "comments", "related", "share", "cookie", "sidebar", "menu", "promo"}


class Node:
    """An open element: a link to the one above it, and what it adds to the path.

    Nothing is copied down the path, so a page costs its length at any depth.
    Nodes of equal paths have the same ``kind``.
    """

    __slots__ = ("above", "tag", "names", "kind", "new", "home", "main", "out")

    def __init__(self, above: Node | None, tag: str, names: tuple[str, ...], kind: int, new: tuple[str, ...]):
        self.above, self.tag, self.names, self.kind, self.new = above, tag, names, kind, new
        self.home = tag == "article" or bool(above and above.home)
        self.main = tag == "main" or bool(above and above.main)
        self.out = tag in _OUT_TAGS or bool(_OUT_NAMES.intersection(names)) or bool(above and above.out)

    def line(self) -> list[Node]:
        """The elements from the outermost to this one."""
        out, node = [], self
        while node:
            out.append(node)
            node = node.above
        return out[::-1]


@dataclass(slots=True)
class Block:
    """A leaf block: its text, the innermost element around it, characters of link text and of svg text."""

    text: str
    node: Node | None
    linked: int
    drawn: int = 0

    @property
    def path(self) -> tuple[tuple[str, tuple[str, ...]], ...]:
        return tuple((n.tag, n.names) for n in self.node.line()) if self.node else ()


class Stack:
    """Open elements, with the places of each tag, so that none is searched for."""

    def __init__(self) -> None:
        self.nodes: list[Node] = []
        self.places: dict[str, list[int]] = defaultdict(list)
        self.open: Counter = Counter()
        self.kinds: dict[tuple, int] = {}

    def top(self) -> Node | None:
        return self.nodes[-1] if self.nodes else None

    def push(self, tag: str, names: tuple[str, ...]) -> None:
        above = self.top()
        kind = self.kinds.setdefault((above.kind if above else 0, tag, names), len(self.kinds) + 1)
        told = [f"in:{tag}", *dict.fromkeys(f"named:{n}" for n in names)]
        node = Node(above, tag, names, kind, tuple(f for f in told if not self.open[f]))
        self.open.update(node.new)
        self.places[tag].append(len(self.nodes))
        self.nodes.append(node)

    def last(self, tags: Iterable[str]) -> int:
        """Place of the innermost element with one of the tags, or -1."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def cut(self, at: int) -> None:
        while len(self.nodes) > at:
            node = self.nodes.pop()
            self.places[node.tag].pop()
            for f in node.new:
                del self.open[f]

    def close(self, tags: Iterable[str], within: Iterable[str] = ()) -> None:
        """End the innermost of the tags, unless one of ``within`` is further inside."""
        at = self.last(tags)
        if at >= 0 and at >= self.last(within):
            self.cut(at)


class Ends:
    """Next places of end tags, each looked for once on the way through a page."""

    def __init__(self, page: str):
        self.page, self.found = page, {}

    def after(self, at: int, tag: str, outer: str = "") -> int | None:
        """Where the text after the end of a raw element goes on; at the end of ``outer`` if that is first."""
        known = self.found.get((tag, outer))
        if known is None or (known[0] is not None and known[0] < at):
            pattern = rf"</{tag}\s*>" + (rf"|(?=</{outer}\s*>)" if outer else "")
            m = re.compile(pattern, re.I).search(self.page, at)
            known = self.found[tag, outer] = (m.start(), m.end()) if m else (None, None)
        return known[1]


def _names(attributes: str) -> tuple[str, ...]:
    """Words of class, id and role, marked roles apart."""
    if "=" not in attributes:
        return ()
    out = []
    for kind, *values in _ATTRIBUTE.findall(attributes):
        words = [w.lower() for w in _PART.findall("".join(values))]
        out += [f"role:{w}" for w in words] if kind.lower() == "role" else words
    return tuple(out)


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks with text, in page order.

    Character references are decoded and white space becomes single blanks.
    Tags may be left open: a paragraph ends where the next block starts. An
    unfinished tag at the end of a page is no text. ``svg``, ``math`` and
    ``object`` are read like other inline elements; in the first two ``/>`` ends
    an element, and a block element ends both.
    """
    page = page or ""
    out: list[Block] = []
    stack, ends = Stack(), Ends(page)
    text: list[str] = []
    links, linked, drawn, at = 0, 0, 0, 0
    foreign: list[str] = []
    inside: Counter = Counter()

    def flush() -> None:
        nonlocal linked, drawn
        if text:
            joined = " ".join(html.unescape("".join(text)).split())
            if joined:
                out.append(Block(joined, stack.top(), linked, drawn))
            text.clear()
        linked = drawn = 0

    def leave_foreign(tag: str = "") -> None:
        """Up to the innermost drawing or formula of that tag, or out of all."""
        while foreign:
            inside[last := foreign.pop()] -= 1
            if last == tag:
                return

    while True:
        m = _TOKEN.search(page, at)
        piece = page[at : m.start()] if m else page[at:]
        if piece:
            text.append(piece)
            if links:
                linked += len(piece)
            if inside["svg"]:
                drawn += len(piece.strip())
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "a":
                links = max(0, links - 1)
            elif tag in FOREIGN_TAGS and inside[tag]:
                leave_foreign(tag)
            elif tag in BLOCK_TAGS and stack.last((tag,)) >= 0:
                flush()
                stack.close((tag,))
                links = 0
                leave_foreign()
            continue
        if tag in FOREIGN_TAGS:
            if not m[3].endswith("/>"):
                foreign.append(tag)
                inside[tag] += 1
        elif tag in RAW_TAGS and foreign:
            # Of a drawing or formula, an element without its end tag goes as far as that.
            if not m[3].endswith("/>"):
                end = ends.after(at, tag, foreign[-1])
                at = at if end is None else end
        elif tag in RAW_TAGS:
            end = ends.after(at, tag)
            at = len(page) if end is None else end
            if tag in ("textarea", "title"):
                continue
        elif tag == "br":
            text.append(" ")
        elif tag == "a":
            links += 1
        elif tag in BLOCK_TAGS:
            flush()
            links = 0
            leave_foreign()
            if tag in CLOSES_P:
                stack.close(("p",), ("table", "button", "article", "section", "div", "td"))
            if tag in ONE_OF:
                stack.close(ONE_OF[tag], ("ul", "ol", "dl", "table", "select", "tr" if tag in ("td", "th") else "table"))
            if tag not in VOID_TAGS:
                stack.push(tag, _names(m[3]))
    flush()
    return out


def _size(n: int, edges: tuple[int, ...]) -> int:
    return sum(n >= e for e in edges)


def own_features(found: list[Block]) -> list[list[str]]:
    """Feature names of each block of a page, without those of the elements above it."""

    def around(b: Block) -> int:
        return b.node.above.kind if b.node.above else 0

    paragraphs = Counter(around(b) for b in found if b.node and b.node.tag == "p")
    out, title_seen, before = [], False, ""
    for i, b in enumerate(found):
        tag = b.node.tag if b.node else ""
        words = b.text.split()
        lower = {w.strip(".,:;!?()").lower() for w in words}
        title_seen |= tag == "h1"
        f = ["bias", f"tag:{tag}", f"words:{_size(len(words), (3, 6, 12, 25, 50))}"]
        f += [f"sign:{w}" for w in lower & SIGNS]
        f.append(f"links:{_size(10 * b.linked // max(1, len(b.text)), (1, 4, 8))}")
        if b.drawn:
            f.append(f"svg:{_size(10 * b.drawn // max(1, len(b.text)), (1, 4, 8))}")
        f.append(f"end:{b.text[-1] if b.text[-1] in '.!?:' else 'x'}")
        f.append(f"beside:{_size(paragraphs[around(b) if b.node else 0], (1, 2, 4))}")
        f.append(f"title:{title_seen}")
        f.append(f"tags:{before}>{tag}")
        if "©" in b.text or "|" in b.text:
            f.append("mark")
        if i == 0 or i == len(found) - 1:
            f.append("first" if i == 0 else "last")
        before = tag
        out.append(f)
    return out


def features(found: list[Block], first: int | None = None) -> list[list[str]]:
    """Feature names of each block of a page, or the first so many; elements above give the tags and names they add."""
    above = [[f for n in b.node.line() for f in n.new] if b.node else [] for b in found[:first]]
    return [own + more for own, more in zip(own_features(found), above)]


# --- the chain ----------------------------------------------------------------


@dataclass(frozen=True)
class Chain:
    """Weights of an article block over another, by feature, and of steps [from, to]."""

    weights: dict[str, float]
    steps: tuple[tuple[float, float], tuple[float, float]]

    def decode(self, rows: list[list[str]]) -> list[bool]:
        """The most likely labels; equal scores go to "not in the article"."""
        get = self.weights.get
        return self._viterbi([sum([get(n, 0.0) for n in names]) for names in rows])

    def label(self, found: list[Block]) -> list[bool]:
        """``decode`` of a page's features, with the sum over the elements above carried downwards."""
        get = self.weights.get
        sums: dict[int, float] = {}

        def above(node: Node | None) -> float:
            way = []
            while node and id(node) not in sums:
                way.append(node)
                node = node.above
            total = sums[id(node)] if node else 0.0
            for n in reversed(way):
                total = sums[id(n)] = total + sum([get(f, 0.0) for f in n.new])
            return total

        return self._viterbi([sum([get(n, 0.0) for n in own]) + above(b.node) for own, b in zip(own_features(found), found)])

    def _viterbi(self, scores: list[float]) -> list[bool]:
        (s00, s01), (s10, s11) = self.steps
        no = yes = 0.0
        back = []
        for i, own in enumerate(scores):
            if i:
                back.append((yes + s10 > no + s00, yes + s11 > no + s01))
                no, yes = max(no + s00, yes + s10), max(no + s01, yes + s11) + own
            else:
                yes = own
        if not scores:
            return []
        label = yes > no
        labels = [label]
        for from_yes in reversed(back):
            label = from_yes[label]
            labels.append(label)
        return labels[::-1]


def _sums(emit: np.ndarray, steps: np.ndarray, size: np.ndarray):
    """Forward-backward: probability of label 1, and expected steps, per page."""
    n, longest = emit.shape
    score = np.stack([np.zeros_like(emit), emit], axis=2)
    ahead, behind = np.zeros((longest, n, 2)), np.zeros((longest, n, 2))
    ahead[0] = score[:, 0]
    for t in range(1, longest):
        ahead[t] = np.logaddexp(ahead[t - 1][:, :1] + steps[0], ahead[t - 1][:, 1:] + steps[1]) + score[:, t]
    for t in range(longest - 2, -1, -1):
        later = behind[t + 1] + score[:, t + 1]
        back = np.logaddexp(steps[:, 0] + later[:, :1], steps[:, 1] + later[:, 1:])
        behind[t] = np.where((size > t + 1)[:, None], back, 0)
    total = np.logaddexp(*ahead[size - 1, np.arange(n)].T)
    p = np.exp(ahead[..., 1] + behind[..., 1] - total)
    pairs = np.zeros((2, 2))
    for t in range(1, longest):
        on = size > t
        for a in (0, 1):
            for b in (0, 1):
                joint = ahead[t - 1][:, a] + steps[a, b] + score[:, t, b] + behind[t][:, b] - total
                pairs[a, b] += np.exp(joint[on]).sum()
    return p.T, pairs, total


def fit(pages: list[tuple[list[list[str]], list[int]]], rounds: int = 180, rate: float = 0.15, penalty: float = 2e-4) -> Chain:
    """Maximum likelihood by Adam over whole pages (features, labels).

    Names seen in a single page are left out. Equal input, equal weights.
    """
    pages = [p for p in pages if p[0]]
    if not pages:
        return Chain({}, ((0.0, 0.0), (0.0, 0.0)))
    seen = Counter(n for rows, _ in pages for n in {n for row in rows for n in row})
    number = {name: i for i, name in enumerate(sorted(n for n, c in seen.items() if c > 1 or len(pages) == 1))}
    size = np.array([len(labels) for _, labels in pages])
    n, longest = len(pages), int(size.max())
    truth = np.zeros((n, longest))
    owner, feature = [], []
    for i, (rows, labels) in enumerate(pages):
        truth[i, : len(labels)] = labels
        for t, row in enumerate(rows):
            known = [number[x] for x in row if x in number]
            feature += known
            owner += [i * longest + t] * len(known)
    owner, feature = np.array(owner, dtype=np.int64), np.array(feature, dtype=np.int64)
    inside = np.arange(longest)[None, :] < size[:, None]
    real = np.zeros((2, 2))
    for i, (_, labels) in enumerate(pages):
        np.add.at(real, (labels[:-1], labels[1:]), 1)
    w, steps = np.zeros(len(number)), np.zeros((2, 2))
    state = [np.zeros_like(x) for x in (w, w, steps, steps)]
    total = size.sum()
    for step in range(1, rounds + 1):
        emit = np.bincount(owner, weights=w[feature], minlength=n * longest).reshape(n, longest)
        p, pairs, _ = _sums(emit, steps, size)
        error = np.where(inside, truth - p, 0).ravel()
        g_w = np.bincount(feature, weights=error[owner], minlength=len(w)) / total - penalty * w
        g_s = (real - pairs) / total - penalty * steps
        for value, g, m, v in ((w, g_w, state[0], state[1]), (steps, g_s, state[2], state[3])):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            value += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return Chain(dict(zip(number, w.tolist())), tuple(map(tuple, steps.tolist())))


# --- labelled pages -----------------------------------------------------------

#: Stands at the start of article texts in made pages, and never reaches a feature.
_SIGN = "\ue000"


def label_by_elements(found: list[Block]) -> list[int]:
    """1 for blocks in an article (or main, without one), outside of what is never article text."""
    has_article = any(b.node and b.node.home for b in found)
    return [int(bool(b.node) and (b.node.home if has_article else b.node.main) and not b.node.out) for b in found]


# Ways to lay out a page. {0} is the content, _ a running number.
_MAINS = (
    "<article>{0}</article>", "<main>{0}</main>", "<main><article>{0}</article></main>",
    '<div id="content">{0}</div>', '<div class="post-content">{0}</div>', '<div class="article-body">{0}</div>',
    '<section class="entry">{0}</section>', '<div class="container"><div class="main-column">{0}</div></div>',
    "<table><tr><td>{0}</td></tr></table>", '<div role="main">{0}</div>', '<article class="post">{0}</article>',
    "<div>{0}</div>", '<div class="story"><div class="text">{0}</div></div>',
)
_MENUS = (
    "<nav>{0}</nav>", '<div class="menu">{0}</div>', '<ul class="navbar">{0}</ul>', '<div id="navigation">{0}</div>',
    '<div role="navigation">{0}</div>', '<nav class="breadcrumb">{0}</nav>', "<div>{0}</div>",
)
_HEADS = ("<header>{0}</header>", '<div class="header">{0}</div>', '<div id="masthead" role="banner">{0}</div>', '<div class="top-bar">{0}</div>')
_SIDES = (
    "<aside>{0}</aside>", '<div class="sidebar">{0}</div>', '<div id="secondary" class="widget">{0}</div>',
    '<aside class="related">{0}</aside>', '<div class="related-posts">{0}</div>', '<div role="complementary">{0}</div>',
)
_ADS = (
    '<div class="ad">{0}</div>', '<div class="advert">{0}</div>', '<div class="ads banner">{0}</div>',
    '<div class="sponsored promo">{0}</div>', '<aside class="ad-slot">{0}</aside>', '<div id="advertisement">{0}</div>',
)
_NOTICES = (
    '<div class="cookie-notice"><p>{0}</p><button>Accept</button></div>', '<div id="cookie-banner">{0}</div>',
    '<div class="notice">{0}</div>', '<div class="alert" role="alert">{0}</div>', '<div class="consent popup"><p>{0}</p></div>',
    '<div class="newsletter"><p>{0}</p></div>', '<dialog><p>{0}</p></dialog>',
)
_FORMS = (
    '<form><label>{0}</label><input type="text"><button>Submit</button></form>', '<form class="search"><p>{0}</p><input></form>',
    '<div class="login-form"><form><p>{0}</p><select><option>One<option>Two</select></form></div>',
)
_COMMENTS = (
    '<section id="comments"><h2>Comments</h2>{0}</section>', '<div class="comments"><h3>Responses</h3>{0}</div>',
    '<div class="comment-list">{0}</div>', '<section class="reader-comments">{0}</section>', '<ol class="commentlist">{0}</ol>',
)
_COMMENT = (
    '<div class="comment"><p>{0}</p></div>', '<div class="comment"><b>Reader</b><p>{0}</p><a href="#r">Reply</a></div>',
    "<p>{0}</p>", '<li class="comment"><p>{0}</p></li>', "<article><p>{0}</p></article>", '<article class="comment"><p>{0}</p></article>',
)
_FOOTS = (
    "<footer>{0}</footer>", '<div class="footer">{0}</div>', '<div id="footer" role="contentinfo"><p>{0}</p></div>',
    "<footer><p>{0}</p></footer>", '<div class="site-footer copyright">{0}</div>',
)
_INNER = ("<p>{0}</p>", "<p>{0}", "<h2>{0}</h2>", "<blockquote><p>{0}</p></blockquote>", "<ul><li>{0}</li></ul>", "<p><b>{0}<br>", "<pre>{0}</pre>", "<div>{0}</div>", "<table><tr><td>{0}</td></tr></table>", "<figure><figcaption>{0}</figcaption></figure>", "<h3>{0}</h3>")
_INNER_ODDS = (12, 4, 2, 1, 1.5, 2, 0.5, 1, 0.7, 0.5, 1)
_SMALL = (
    "Home", "About us", "Contact", "Read more", "Share this", "Subscribe to our newsletter", "All rights reserved",
    "We use cookies to improve this site. Accept all cookies?", "Privacy policy", "Sign in", "Search", "Related stories",
    "Posted by a reader, reply below", "Advertisement", "Follow us", "Next page", "Terms of use", "Leave a comment",
)


def make_page(rng: np.random.Generator, texts: list[str], small: list[str]) -> str:
    """A page laid out by chance; article texts start with ``_SIGN``."""

    def pick(options):
        return options[rng.integers(len(options))]

    def often(share: float) -> bool:
        return rng.random() < share

    def sentence() -> str:
        # Boilerplate may read just like an article.
        return html.escape(pick(texts) if texts and often(0.6) else pick(small))

    def links(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{i}">{html.escape(pick(small))}</a></li>' for i in range(n)) + "</ul>"

    def own(text: str) -> str:
        return _SIGN + html.escape(text)

    inner = [f"<h1>{own(pick(texts)[:60])}</h1>"] if often(0.9) else []
    odds = np.array(_INNER_ODDS) / sum(_INNER_ODDS)
    for _ in range(int(rng.integers(1, 12))):
        inner.append(_INNER[rng.choice(len(_INNER), p=odds)].format(own(pick(texts))))
        if often(0.08):
            inner.append(pick(_ADS).format(sentence()))
    if often(0.1):
        inner.append('<div class="share">' + links(3) + "</div>")
    comments = pick(_COMMENTS).format("".join(pick(_COMMENT).format(sentence()) for _ in range(rng.integers(1, 5))))
    place = rng.random()
    if place < 0.15:
        inner.append(comments)
    main = pick(_MAINS).format("".join(inner))
    parts = []
    if often(0.3):
        parts.append(pick(_NOTICES).format(sentence()))
    if often(0.5):
        parts.append(pick(_HEADS).format(pick((sentence(), f"<h2>{sentence()}</h2>", links(2)))))
    if often(0.8):
        parts.append(pick(_MENUS).format(links(int(rng.integers(2, 8)))))
    if often(0.6):
        parts.append(pick(_ADS).format(pick(("{0}", "<p>{0}</p>")).format(sentence())))
    side = pick(_SIDES).format(pick((links(4), f"<p>{sentence()}</p>", f"<h3>Related</h3>{links(3)}", sentence())))
    after = [side] if often(0.5) else []
    if 0.15 <= place < 0.5:
        after.append(comments)
    if often(0.25):
        after.append(pick(_FORMS).format(sentence()))
    if often(0.15):
        after.append(pick(_NOTICES).format(sentence()))
    if often(0.3) and after:
        parts.append(after.pop(0))
    after.append(pick(_FOOTS).format(pick(("&copy; ", "")) + sentence()))
    if often(0.1):
        after[-1] = ""
    head = '<!DOCTYPE html><html><head><title>x</title><style>p{margin:0}</style><script>var t="</p>";</script></head><body>'
    return head + "".join([*parts, main, *after]) + pick(("</body></html>", ""))


def made_pages(texts: list[str], small: list[str], n: int, seed: int) -> list[tuple[list[list[str]], list[int]]]:
    """Features and labels of ``n`` pages laid out by chance."""
    rng = np.random.default_rng(seed)
    texts = texts or ["A sentence of an article, with some words in it.", "Another one that goes on for a bit longer."]
    out = []
    for _ in range(n):
        found = blocks(make_page(rng, texts, [*_SMALL, *small]))
        labels = [int(_SIGN in b.text) for b in found]
        for b in found:
            b.text = b.text.replace(_SIGN, "") or "x"
        out.append((features(found), labels))
    return out


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, made: int = MADE_PAGES, seed: int = 5) -> Chain:
    """A chain from at most ``sample_pages`` pages and as many made ones as told.

    The pages with the smallest hashes of their ids are read on the executors;
    what comes back is their features, labels and the start of their texts, for
    a bounded number of blocks. An empty table trains on made pages alone.
    """
    place = F.xxhash64(F.col("page_id"), F.lit(seed))
    total = pages.count()
    labelled: list[tuple[list[list[str]], list[int]]] = []
    texts: set[str] = set()
    small: set[str] = set()
    if total:

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kind = pa.list_(pa.struct([("text", pa.string()), ("label", pa.int32()), ("names", pa.list_(pa.string()))]))
            for batch in slices(batches):
                rows = []
                for page in batch.column(0).to_pylist():
                    found = blocks(page)
                    cut = zip(found[:SAMPLE_BLOCKS], label_by_elements(found), features(found, SAMPLE_BLOCKS))
                    rows.append([{"text": b.text[:SAMPLE_CHARS], "label": y, "names": f[:SAMPLE_NAMES]} for b, y, f in cut])
                yield pa.RecordBatch.from_arrays([pa.array(rows, kind)], ["blocks"])

        sample = pages.filter(sampled(place, sample_pages, total)).orderBy(place).limit(sample_pages).select(F.col("html").cast("string"))
        for (found,) in sample.mapInArrow(read, "blocks array<struct<text:string,label:int,names:array<string>>>").collect():
            labels = [b.label for b in found]
            if any(labels):
                labelled.append(([list(b.names) for b in found], labels))
                texts.update(b.text for b in found if b.label)
                small.update(b.text for b in found if not b.label)
    return fit(labelled + made_pages(sorted(texts), sorted(small), made, seed))


# --- use ----------------------------------------------------------------------


def main_text(page: str | None, chain: Chain) -> str:
    """The article's blocks joined by blank lines; empty for a missing or empty page, or without any."""
    found = blocks(page)
    keep = chain.label(found)
    return "\n\n".join(b.text for b, k in zip(found, keep) if k)


def extract(pages: DataFrame, chain: Chain) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    A missing or empty page, and one without article blocks, has an empty text.
    Repeated rows give equal texts, an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [main_text(page, chain) for page in batch.column(2).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    narrow = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return narrow.mapInArrow(run, "page_id long, url string, text string, n_chars long")
