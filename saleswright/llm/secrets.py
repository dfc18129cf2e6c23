"""Secrets: fixed patterns, and a character network for what they miss.

Every token long enough to be a key, with letters and digits, is a candidate. A
convolutional network reads the characters of the candidate and around it; one
channel tells the two apart, and pools over the candidate and its surroundings
lead to one score. It is trained on labelled findings of all documents: those of
the patterns, the other candidates unless they have the form of a known key, and
tokens of known kinds planted in the surroundings of every one of them. Tasks
train on parts of these windows in numpy, and their weights are averaged after
each pass. Scores are calibrated on all candidates held back from training, and
the threshold is the highest one that keeps the wanted recall of them there,
each with its best window.
"""

from __future__ import annotations

import hashlib
import re
import string
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fixed, slices

# The patterns and the least length of what they find.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{24,}")
MIN_ASSIGN, MIN_ACCESS = 6, 20
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "model")

CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{12,}")
_DIGIT, _LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")

#: Characters before and after a candidate, and of it, that the network sees at
#: once. A longer candidate is seen in several windows; the highest score counts.
AROUND, INSIDE = 20, 40
WIDTH = INSIDE + 2 * AROUND
#: Tokens planted at least, windows that a task trains on, and passes over them.
PLANTED, SHARD, EPOCHS = 1500, 20_000, 8
#: Windows that a task plants tokens into.
PLANT = 2000
RECALL = 0.98
#: Steps of a score within which held-back candidates are counted together.
STEPS = 1000
#: Windows that a worker gathers before it scores them.
SCORED = 16_384
SPANS = "array<struct<kind:string,start:int,end:int,value_start:int,score:double>>"


def base_spans(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the secret itself) by the patterns."""
    found = []
    lower = text.lower()
    if any(k in lower for k in KEYWORDS):
        found += [("assign", *m.span(), m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [("access", *m.span(), m.start()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    found += [("hex", *m.span(), m.start()) for m in HEX.finditer(text)]
    return found


class Reach:
    """Spans by start with the furthest end so far, so that a place is looked up and not searched for."""

    def __init__(self, spans: list[tuple[str, int, int, int]]):
        bounds = sorted((start, end) for _, start, end, _ in spans)
        self.starts = [start for start, _ in bounds]
        self.ends = list(accumulate((end for _, end in bounds), max))

    def hold(self, a: int, b: int) -> bool:
        """Whether the place lies wholly inside a span."""
        at = bisect_right(self.starts, a)
        return at > 0 and self.ends[at - 1] >= b

    def touch(self, a: int, b: int) -> bool:
        """Whether the place has a character of a span."""
        at = bisect_left(self.starts, b)
        return at > 0 and self.ends[at - 1] > a


def candidates(text: str) -> list[tuple[int, int]]:
    """Tokens that could be a key: twelve or more characters, letters and digits."""
    if not _DIGIT.search(text):
        return []
    spans = (m.span() for m in CANDIDATE.finditer(text) if _DIGIT.search(m[0]) and _LETTER.search(m[0]))
    # A sentence's full stop or a padding is not part of a word-like token.
    return [(a, b - (text[b - 1] == ".")) for a, b in spans]


def windows(text: str, start: int, end: int) -> list[tuple[str, int, int]]:
    """Windows over a candidate: the characters, and where the candidate is in them."""
    out = []
    for at in range(start, end, INSIDE):
        stop = min(end, at + INSIDE)
        left = text[max(0, at - AROUND) : at]
        out.append((left + text[at:stop] + text[stop : stop + AROUND], len(left), len(left) + stop - at))
    return out


# --- the network --------------------------------------------------------------

_ALPHABET = 97  # printable ASCII, then everything else; zero is padding
EMBED, FILTERS, KERNEL, HIDDEN = 8, 24, 5, 16


def encode(items: list[tuple[str, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Character numbers and candidate marks, each (windows, WIDTH)."""
    chars = np.zeros((len(items), WIDTH), dtype=np.int64)
    marks = np.zeros((len(items), WIDTH), dtype=np.float32)
    for row, (text, a, b) in enumerate(items):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        chars[row, : len(codes)] = np.where((codes >= 32) & (codes < 127), codes - 31, _ALPHABET - 1)
        marks[row, a:b] = 1
    return chars, marks


def _start(seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    size = {
        "embed": (_ALPHABET, EMBED),
        "conv": (KERNEL * (EMBED + 1), FILTERS),
        "conv_b": (FILTERS,),
        "dense": (2 * FILTERS, HIDDEN),
        "dense_b": (HIDDEN,),
        "out": (HIDDEN, 1),
        "out_b": (1,),
    }
    return {k: (rng.normal(0, 1, s) * np.sqrt(2 / s[0]) if len(s) > 1 else np.zeros(s)).astype(np.float32) for k, s in size.items()}


def _forward(w: dict[str, np.ndarray], chars: np.ndarray, marks: np.ndarray):
    x = np.concatenate([w["embed"][chars], marks[..., None]], axis=2)
    seen = np.lib.stride_tricks.sliding_window_view(x, KERNEL, axis=1).transpose(0, 1, 3, 2)
    seen = seen.reshape(len(x), WIDTH - KERNEL + 1, -1)
    conv = np.maximum(seen @ w["conv"] + w["conv_b"], 0)
    inside = marks[:, KERNEL // 2 : -(KERNEL // 2), None] > 0
    ins, out = np.where(inside, conv, 0), np.where(inside, 0, conv)
    at_in, at_out = ins.argmax(axis=1), out.argmax(axis=1)
    pooled = np.concatenate([ins.max(axis=1), out.max(axis=1)], axis=1)
    hidden = np.maximum(pooled @ w["dense"] + w["dense_b"], 0)
    return (hidden @ w["out"] + w["out_b"])[:, 0], (seen, at_in, at_out, pooled, hidden)


def _backward(w, chars, kept, error) -> dict[str, np.ndarray]:
    """Gradients from ``error``, the slope of the loss by each window's score."""
    seen, at_in, at_out, pooled, hidden = kept
    g = {"out": hidden.T @ error[:, None], "out_b": error.sum(keepdims=True)}
    d_hidden = error[:, None] * w["out"][:, 0] * (hidden > 0)
    g["dense"], g["dense_b"] = pooled.T @ d_hidden, d_hidden.sum(axis=0)
    d_pooled = (d_hidden @ w["dense"].T) * (pooled > 0)
    d_conv = np.zeros((len(seen), seen.shape[1], FILTERS), dtype=np.float32)
    rows, cols = np.arange(len(seen))[:, None], np.arange(FILTERS)[None, :]
    d_conv[rows, at_in, cols] += d_pooled[:, :FILTERS]
    d_conv[rows, at_out, cols] += d_pooled[:, FILTERS:]
    flat = d_conv.reshape(-1, FILTERS)
    g["conv"], g["conv_b"] = seen.reshape(len(flat), -1).T @ flat, flat.sum(axis=0)
    d_seen = (flat @ w["conv"].T).reshape(len(seen), -1, KERNEL, EMBED + 1)
    d_x = np.zeros((len(seen), WIDTH, EMBED), dtype=np.float32)
    for k in range(KERNEL):
        d_x[:, k : k + seen.shape[1]] += d_seen[:, :, k, :EMBED]
    g["embed"] = np.zeros_like(w["embed"])
    np.add.at(g["embed"], chars.ravel(), d_x.reshape(-1, EMBED))
    return g


def _fresh_state(seed: int) -> np.ndarray:
    """Weights, both of Adam's means and its step count, put behind each other."""
    weights = _start(seed)
    size = sum(v.size for v in weights.values())
    return np.concatenate([*(v.ravel() for v in weights.values()), np.zeros(2 * size + 1)])


def _unpacked(state: np.ndarray) -> tuple[dict, dict, dict, int]:
    parts, at = [], 0
    for _ in range(3):
        part = {}
        for k, v in _start(0).items():
            part[k] = state[at : at + v.size].reshape(v.shape).astype(np.float32)
            at += v.size
        parts.append(part)
    return *parts, int(round(state[at]))


def fit_network(chars, marks, labels, state: np.ndarray, epochs: int = 1, rate: float = 3e-3, batch: int = 128, seed: int = 7) -> np.ndarray:
    """The state after Adam on the logistic loss; equal inputs give equal states."""
    w, mean, square, step = _unpacked(state)
    rng = np.random.default_rng([seed, step])
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            score, kept = _forward(w, chars[rows], marks[rows])
            error = (1 / (1 + np.exp(-score)) - labels[rows]).astype(np.float32) / len(rows)
            step += 1
            for k, g in _backward(w, chars[rows], kept, error).items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                w[k] -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
    return np.concatenate([*(v.ravel() for part in (w, mean, square) for v in part.values()), [step]])


# --- training -----------------------------------------------------------------

# Forms of keys in use, as prefix, alphabet and length, and names
# that stand before them.
_B62 = string.ascii_letters + string.digits
_KEY_FORMS = (
    ("AKIA", string.ascii_uppercase + string.digits, 16),
    ("ghp_", _B62, 36),
    ("xoxb-", string.digits + "-" + _B62, 48),
    ("sk_live_", _B62, 24),
    ("AIza", _B62 + "-_", 35),
    ("eyJ", _B62 + "-_.", 90),
    ("", "0123456789abcdef", 40),
    ("", "0123456789abcdef", 32),
    ("", _B62 + "+/", 40),
    ("", _B62, 24),
)
#: Runs of an alphabet with a key's length, or its prefix and about that length.
_LOOKS = re.compile(
    "|".join(
        f"(?<![A-Za-z0-9]){p}[{re.escape(a)}]{{{n * 2 // 3},}}" if p else f"(?<![{re.escape(a)}])[{re.escape(a)}]{{{n}}}(?![{re.escape(a)}])"
        for p, a, n in _KEY_FORMS
    )
)


def looks_like_key(token: str) -> bool:
    """Whether a known form of keys is in the token, such as behind ``name=``."""
    return any(_DIGIT.search(m[0]) and _LETTER.search(m[0]) for m in _LOOKS.finditer(token))


_NAMES = ("token = ", "password: ", "secret=", "api_key: '", "auth ", "key=", "credential ", "bearer ", "", "")


def _planted(rng: np.random.Generator, contexts: list[str], n: int) -> tuple[list, list[int]]:
    """Labelled windows made by putting tokens of known kinds into contexts."""
    items, labels, _ = _planted_candidates(rng, contexts, n)
    return items, labels


def _planted_candidates(rng: np.random.Generator, contexts: list[str], n: int, first: int = 0) -> tuple[list, list[int], list[int]]:
    """Windows and labels like ``_planted``, and the number of each window's candidate, from ``first``; even ones are secrets."""

    def draw(alphabet: str, size: int) -> str:
        return "".join(alphabet[i] for i in rng.integers(0, len(alphabet), size))

    def word(size: int) -> str:
        return "".join(draw("bcdfglmnprst", 1) + draw("aeiou", 1) for _ in range(size // 2))

    def key() -> str:
        prefix, alphabet, size = _KEY_FORMS[rng.integers(len(_KEY_FORMS))]
        return prefix + draw(alphabet, size)

    def harmless() -> str:
        day = f"{rng.integers(1990, 2030)}-{rng.integers(1, 13):02d}-{rng.integers(1, 29):02d}"
        number = str(rng.integers(1, 999))
        forms = (
            f"www.{word(8)}{number}.com",
            f"mail{number}.{word(8)}.org",
            f"{word(6)}/{word(8)}/{number}.html",
            f"{word(8)}-{word(6)}-{number}",
            f"{day}T{rng.integers(10, 24)}-00-00Z",
            f"version-{number}.{number}.{number}-{word(4)}",
            f"{word(10)}_{word(8)}_{number}",
            f"{word(12).title()}{number}{word(6).title()}",
            f"ISBN-978-{draw(string.digits, 9)}",
            f"+{draw(string.digits, 3)}-{draw(string.digits, 7)}-ext{number}",
        )
        return forms[rng.integers(len(forms))]

    items, labels, owners = [], [], []
    for i in range(first, first + n):
        context = contexts[rng.integers(len(contexts))] if contexts else "and so on with more words around it here "
        cut = rng.integers(0, max(1, len(context)))
        secret = i % 2 == 0
        token = key() if secret else harmless()
        name = _NAMES[rng.integers(len(_NAMES))] if secret else ""
        before = f"{context[:cut]} {name}"
        text = f"{before}{token} {context[cut:]}"
        for window in windows(text, len(before), len(before) + len(token)):
            items.append(window)
            labels.append(int(secret))
            owners.append(i)
    return items, labels, owners


@dataclass(frozen=True)
class SecretModel:
    """Weights, calibration (slope, offset) and threshold of the network."""

    weights: dict[str, np.ndarray]
    slope: float
    offset: float
    threshold: float
    recall: float

    def scores(self, items: list[tuple[str, int, int]]) -> np.ndarray:
        """Calibrated probability of each window."""
        out = [np.empty(0)]
        for at in range(0, len(items), 512):
            score = _forward(self.weights, *encode(items[at : at + 512]))[0].astype(float)
            out.append(1 / (1 + np.exp(-(self.slope * score + self.offset))))
        return np.concatenate(out)


def calibrate(scores: np.ndarray, labels: np.ndarray, counts: np.ndarray | int = 1, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic curve through (score, label), each so many times, by Newton steps.

    Labels are drawn in from 0 and 1, so separable scores stay finite.
    """
    counts = np.broadcast_to(counts, labels.shape)
    up, down = counts[labels == 1].sum(), counts[labels == 0].sum()
    target = np.where(labels == 1, (up + 1) / (up + 2), 1 / (down + 2))
    x = np.stack([scores, np.ones_like(scores)], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        curve = x.T @ (x * (counts * (p * (1 - p) + 1e-6))[:, None]) + 1e-3 * np.eye(2)
        beta = beta + np.linalg.solve(curve, x.T @ (counts * (target - p)) - 1e-3 * (beta - [1.0, 0.0]))
    return float(beta[0]), float(beta[1])


def _labelled(text: str) -> list[tuple[str, int, int, int, str]]:
    """Windows over the candidates of a text, labelled by the patterns, with a digest of the candidate.

    What no pattern finds but has the form of a known key is neither a secret
    nor harmless for sure, and is left out.
    """
    base = Reach(base_spans(text))
    out = []
    for a, b in candidates(text):
        label = int(base.touch(a, b))
        if label or not looks_like_key(text[a:b]):
            around = text[max(0, a - AROUND) : b + AROUND].encode("utf-8", "surrogatepass")
            owner = hashlib.blake2b(around, digest_size=16).hexdigest()
            out += [(*w, label, owner) for w in windows(text, a, b)]
    return out


def best_by_owner(values: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """The highest value of each candidate's windows."""
    _, number = np.unique(owners, return_inverse=True)
    best = np.full(number.max(initial=-1) + 1, -np.inf)
    np.maximum.at(best, number, values)
    return best


def threshold_for(best: np.ndarray, recall: float, counts: np.ndarray | int = 1) -> float:
    """The highest threshold that keeps ``recall`` of the findings with these scores, each so many times."""
    order = np.argsort(best)
    below = np.cumsum(np.broadcast_to(counts, best.shape)[order])
    lost = int(np.floor((1 - recall) * below[-1] + 1e-9))
    return float(best[order][np.searchsorted(below, lost, side="right")])


_WINDOWS = "window string, a int, b int, label int, owner string"


def _window_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
    columns = list(zip(*rows)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["window", "a", "b", "label", "owner"])


def labelled_windows(docs: DataFrame) -> DataFrame:
    """The distinct labelled windows of all documents."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield _window_batch([w for t in batch.column(0).to_pylist() for w in _labelled(t or "")])

    return docs.select(F.col("text").cast("string")).mapInArrow(cut, _WINDOWS).distinct()


def with_planted(spark: SparkSession, found: DataFrame, n: int, planted: int, seed: int) -> DataFrame:
    """``found``, ``n`` windows, and at least ``planted`` tokens put into their surroundings, as many into each.

    What is planted hangs on the window alone, not on where it lies.
    """
    each = -(-planted // n) if n else planted

    def plant(window: tuple | None) -> list[tuple]:
        text, a, b, _, owner = window or ("", 0, 0, 0, "")
        # A window's number tells apart those of one candidate.
        mark = hashlib.blake2b(f"{seed} {owner} {a} {b} {text}".encode("utf-8", "surrogatepass"), digest_size=8).digest()
        number = int.from_bytes(mark, "little")
        contexts = [text[:a] + text[b:]] if window else []
        cut = _planted_candidates(np.random.default_rng(number), contexts, each, first=number % 2)
        return [(*item, label, f"planted {mark.hex()} {i}") for item, label, i in zip(*cut)]

    if not n:
        return spark.createDataFrame(plant(None), _WINDOWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [tuple(r.values()) for r in batch.to_pylist()]
            yield _window_batch(rows + [x for r in rows for x in plant(r)])

    # By number, as the bytes of the windows tell little of the work on them.
    return found.repartition(-(-n // PLANT), "window").mapInArrow(run, _WINDOWS)


def _fitted(windows: DataFrame, seed: int) -> dict[str, np.ndarray]:
    """Weights from all ``windows``: every task trains on its part, and the states are averaged after each pass.

    The parts go by hash and are sorted, so that equal windows give equal weights however they lie.
    """
    n = windows.count()
    shards = max(1, -(-n // SHARD))
    parted = windows.withColumn("shard", F.pmod(F.xxhash64("window", "a", "b", F.lit(seed)), F.lit(shards))).repartition(shards, "shard")
    state = _fresh_state(seed)
    # One part alone needs no averaging between its passes.
    epochs = EPOCHS if shards == 1 else 1

    def fit(part: pa.Table) -> pa.Table:
        rows = sorted(tuple(r.values()) for r in part.drop_columns(["shard"]).to_pylist())
        labels = np.array([r[3] for r in rows], dtype=np.float32)
        after = fit_network(*encode([r[:3] for r in rows]), labels, state, epochs, seed=seed)
        return pa.table({"n": pa.array([len(rows)], pa.int64()), "state": pa.array([after.tolist()], pa.list_(pa.float64()))})

    for _ in range(EPOCHS // epochs):
        after = parted.groupBy("shard").applyInArrow(fit, "n long, state array<double>")
        summed = after.select("n", F.posexplode("state")).groupBy("pos").agg(F.sum(F.col("col") * F.col("n")) / F.sum("n"))
        state = np.array([x for _, x in sorted(map(tuple, summed.collect()))])
    return _unpacked(state)[0]


def _held_scores(held: DataFrame, weights: dict[str, np.ndarray]) -> DataFrame:
    """``owner, label, score`` of held-back windows, the score uncalibrated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 512):
            items = list(zip(*(batch.column(c).to_pylist() for c in ("window", "a", "b"))))
            score = _forward(weights, *encode(items))[0].astype(float)
            yield pa.RecordBatch.from_arrays([batch.column("owner"), batch.column("label"), pa.array(score)], ["owner", "label", "score"])

    return held.mapInArrow(run, "owner string, label int, score double")


def train(docs: DataFrame, sample_candidates: int = 2 * PLANTED, recall: float = RECALL, seed: int = 7) -> SecretModel:
    """A model from the labelled findings of all documents.

    Nothing is left out: every distinct window is trained on or, with all others
    of its candidate, held back; every one of these counts for calibration and
    threshold. Held-back scores come to the driver as counts per thousandth,
    weights as one average. At least half of ``sample_candidates`` tokens are
    planted, one in every window or more. A table without candidates trains on
    planted ones alone; the model of an empty table, which has nothing to
    search, has a threshold of 0.5 at least.
    """
    found = fixed(labelled_windows(docs))
    n = found.count()
    windows = fixed(with_planted(docs.sparkSession, found, n, sample_candidates // 2, seed))
    held = F.pmod(F.xxhash64("owner", F.lit(seed)), F.lit(4)) == 3
    weights = _fitted(windows.filter(~held), seed)
    scores = fixed(_held_scores(windows.filter(held), weights))
    bin_of = F.floor(F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col("score"))) * STEPS)
    counted = scores.groupBy("label", bin_of).agg(F.avg("score").alias("score"), F.count(F.lit(1)).alias("n")).collect()
    counted = sorted((r.score, r.label, r.n) for r in counted)
    slope, offset = calibrate(*(np.array(c) for c in zip(*counted)))
    best = scores.filter("label = 1").groupBy("owner").agg(F.max("score").alias("score"))
    least = best.groupBy(bin_of).agg(F.min("score").alias("score"), F.count(F.lit(1)).alias("n")).collect()
    score, many = (np.array(c) for c in zip(*sorted((r.score, r.n) for r in least)))
    p = 1 / (1 + np.exp(-(slope * score + offset)))
    threshold = threshold_for(p, recall, many)
    if not n and docs.isEmpty():
        threshold = max(threshold, 0.5)
    return SecretModel(weights, slope, offset, threshold, float(many[p >= threshold].sum() / many.sum()))


# --- use ----------------------------------------------------------------------


def spans_of(texts: list[str], model: SecretModel) -> list[list[tuple[str, int, int, int, float]]]:
    """(kind, start, end, start of the secret, score) per text, by start, then kind."""
    out: list[list] = []
    items: list[tuple[str, int, int]] = []
    owner: list[tuple[int, int, int]] = []
    best: dict[tuple[int, int, int], float] = {}

    def score() -> None:
        for key, p in zip(owner, model.scores(items).tolist()):
            best[key] = max(p, best.get(key, 0.0))
        items.clear()
        owner.clear()

    for row, text in enumerate(texts):
        base = base_spans(text)
        out.append([(*s, 1.0) for s in base])
        reach = Reach(base)
        for a, b in candidates(text):
            if not reach.hold(a, b):
                cut = windows(text, a, b)
                items += cut
                owner += [(row, a, b)] * len(cut)
                if len(items) >= SCORED:
                    score()
    score()
    for (row, a, b), p in best.items():
        if p >= model.threshold:
            out[row].append(("model", a, b, a, round(p, 4)))
    return [sorted(s, key=lambda x: (x[1], KINDS.index(x[0]))) for s in out]


def find_secrets(docs: DataFrame, model: SecretModel) -> DataFrame:
    """``doc_id`` and an array of spans ``kind, start, end, value_start, score``.

    Code points, end exclusive, by start, then kind. Pattern spans have score 1;
    no span of the network lies wholly inside one of those. A missing text counts as empty,
    repeated rows have equal spans, an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("kind", "start", "end", "value_start", "score")
        kind = pa.list_(
            pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value_start", pa.int32()), ("score", pa.float64())])
        )
        for batch in slices(batches):
            found = spans_of([t or "" for t in batch.column(1).to_pylist()], model)
            spans = pa.array([[dict(zip(names, s)) for s in row] for row in found], kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), spans], ["doc_id", "spans"])

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInArrow(run, f"doc_id long, spans {SPANS}")


def redact(docs: DataFrame, model: SecretModel, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark``; no row is dropped.

    A missing text stays missing, an empty one empty, and repeated rows get
    equal texts. Of an assignment only the value goes. ``n_chars``, where there is a whole
    number of that name, follows the new text of changed rows.
    """
    columns = docs.columns
    at = columns.index("text")
    counted = "n_chars" in columns and isinstance(docs.schema["n_chars"].dataType, (T.IntegerType, T.LongType))
    size = columns.index("n_chars") if counted else None

    def clean(text: str, spans: list) -> str:
        kept, done = [], 0
        for _, _, end, start, _ in sorted(spans, key=lambda s: (s[3], s[2])):
            if end <= done:
                continue
            if start >= done:
                kept += [text[done:start], mark]
            done = end
        return "".join([*kept, text[done:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(at).to_pylist()
            found = spans_of([t or "" for t in texts], model)
            if any(found):
                arrays = list(batch.columns)
                texts = [clean(t, s) if s else t for t, s in zip(texts, found)]
                arrays[at] = pa.array(texts, arrays[at].type)
                if size is not None:
                    old = arrays[size].to_pylist()
                    counts = [len(t) if s else n for t, s, n in zip(texts, found, old)]
                    arrays[size] = pa.array(counts, arrays[size].type)
                batch = pa.RecordBatch.from_arrays(arrays, schema=batch.schema)
            yield batch

    return docs.mapInArrow(run, docs.schema)
