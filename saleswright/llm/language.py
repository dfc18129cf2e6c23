"""Language of documents by a bidirectional gated recurrent network over bytes.

The network reads windows that together cover the whole text, forwards and
backwards, and gives every byte a probability of each language; a document's
probabilities are the mean over its bytes. It is trained here, in numpy, by
back-propagation through time on windows from a bounded, hashed sample of
documents with a known language. The input to a prediction is the text alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sampled, slices

UNKNOWN = "und"
#: Bytes per window, width of each direction's state, and windows read at a time.
LENGTH, STATE, BATCH = 96, 8, 2048
PAD = 256
#: Bounds of the training sample: documents per language, and windows of each.
SAMPLE_DOCUMENTS, SAMPLE_WINDOWS = 400, 4
STEPS, TRAIN_BATCH, RATE = 240, 192, 0.012
#: A document is accepted as being in its language if the mean probability is this
#: many times that of an even split; a text of a word or two can't be much surer.
LEAST_OVER_EVEN = 1.2

#: Parts that the windows are dealt into, each held back from the counts that judge it; windows that it
#: takes to see what is rare; lengths in bytes that limits are given for.
FOLDS, LEAST_HELD, LENGTHS = 4, 100, (8, 16, 32, 64, LENGTH)
#: The share of windows taken for the end of what is usual, and how many times
#: that distance from the median a text may be.
RARE, BEYOND = 0.001, 1.3
#: With so many windows, the least distance is twice what chance gives.
FEW = 10

_LETTER = re.compile(r"[^\W\d_]")


# --- the network --------------------------------------------------------------


def _squash(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|), in place: an S-curve far cheaper than the usual ones.

    Its slope is the square of 1 - |value|.
    """
    size = np.abs(x)
    size += 1
    x /= size
    return x


def _run(bytes_in: np.ndarray, rows: np.ndarray, within: np.ndarray, keep: bool):
    """States (time, windows, STATE) of one direction over ``bytes_in`` (time, windows).

    ``rows`` has the input part of the three gates (update, reset, new) for
    every byte value, ``within`` the part of the last state.
    """
    steps, n = bytes_in.shape
    states = np.empty((steps, n, STATE), dtype=np.float32)
    last = np.zeros((n, STATE), dtype=np.float32)
    kept = []
    for t in range(steps):
        at = bytes_in[t]

        def gate(i: int) -> np.ndarray:
            x = np.take(rows[i], at, axis=0, mode="clip")
            x += last @ within[i]
            x = _squash(x)
            x *= 0.5
            x += 0.5
            return x

        update, reset = gate(0), gate(1)
        own = last @ within[2]
        new = np.take(rows[2], at, axis=0, mode="clip")
        new += reset * own
        new = _squash(new)
        if keep:
            kept.append((update, reset, new, own, last))
        state = states[t]
        np.subtract(last, new, out=state)
        state *= update
        state += new
        last = state
    return states, kept


def _back(bytes_in: np.ndarray, within: np.ndarray, kept: list, slope: np.ndarray):
    """Gradients of ``rows`` and ``within`` from the slope by every state."""
    steps, n = bytes_in.shape
    g_within = np.zeros_like(within)
    inputs = np.empty((3, steps, n, STATE), dtype=np.float32)
    later = np.zeros((n, STATE), dtype=np.float32)

    def gate_slope(x: np.ndarray) -> np.ndarray:
        return 0.5 * (1 - np.abs(2 * x - 1)) ** 2

    for t in range(steps - 1, -1, -1):
        update, reset, new, own, last = kept[t]
        d = slope[t] + later
        d_new = d * (1 - update) * (1 - np.abs(new)) ** 2
        d_gates = (d * (last - new) * gate_slope(update), d_new * own * gate_slope(reset), d_new)
        d_own = (*d_gates[:2], d_new * reset)
        later = d * update
        for i in range(3):
            inputs[i, t] = d_gates[i]
            g_within[i] += last.T @ d_own[i]
            later += d_own[i] @ within[i].T
    flat = bytes_in.ravel()
    g_rows = np.empty((3, PAD + 1, STATE), dtype=np.float32)
    for i in range(3):
        for j in range(STATE):
            g_rows[i, :, j] = np.bincount(flat, weights=inputs[i, :, :, j].ravel(), minlength=PAD + 1)
    return g_rows, g_within


@dataclass(frozen=True)
class LanguageModel:
    """The languages learned and the weights that tell them apart."""

    languages: tuple[str, ...]
    weights: dict[str, np.ndarray]
    usual: Usual | None = None

    def positions(self, windows: np.ndarray) -> np.ndarray:
        """Probability of each language at every byte: (time, windows, languages)."""
        w = self.weights
        ahead, _ = _run(windows, w["ahead"], w["ahead_u"], keep=False)
        behind, _ = _run(windows[::-1], w["behind"], w["behind_u"], keep=False)
        return _softmax(_scores(w, ahead, behind[::-1]))

    def documents(self, texts: list[str]) -> np.ndarray:
        """Mean probability of each language over all bytes of each text."""
        total = np.zeros((len(texts), len(self.languages)))
        size = np.zeros(len(texts))
        for owner, windows in _batches(texts):
            seen = windows < PAD
            p = np.einsum("tnk,tn->nk", self.positions(windows), seen.astype(np.float32))
            np.add.at(total, owner, p)
            np.add.at(size, owner, seen.sum(axis=0))
        return total / np.maximum(size, 1)[:, None]


def _scores(w: dict[str, np.ndarray], ahead: np.ndarray, behind: np.ndarray) -> np.ndarray:
    return ahead @ w["out_a"] + behind @ w["out_b"] + w["bias"]


def _softmax(scores: np.ndarray) -> np.ndarray:
    # A gate's state stays within (-1, 1), so scores are bounded by the weights.
    e = np.exp(scores)
    e /= e.sum(axis=2, keepdims=True)
    return e


def split(text: str) -> np.ndarray:
    """The text's bytes as windows (windows, LENGTH), the last one padded."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    out = np.full((-(-len(raw) // LENGTH), LENGTH), PAD, dtype=np.int16)
    out.reshape(-1)[: len(raw)] = raw
    return out


def _batches(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row of each window, windows as (time, windows)), at most BATCH at a time."""
    rows, parts, n = [], [], 0
    for i, text in enumerate(texts):
        windows = split(text)
        for at in range(0, len(windows), BATCH):
            part = windows[at : at + BATCH]
            rows.append(np.full(len(part), i))
            parts.append(part)
            n += len(part)
            while n >= BATCH:
                own, joined = np.concatenate(rows), np.concatenate(parts)
                yield own[:BATCH], np.ascontiguousarray(joined[:BATCH].T)
                rows, parts, n = [own[BATCH:]], [joined[BATCH:]], n - BATCH
    if n:
        yield np.concatenate(rows), np.ascontiguousarray(np.concatenate(parts).T)


def fit(windows: np.ndarray, labels: np.ndarray, languages: tuple[str, ...], steps: int = STEPS, seed: int = 11) -> LanguageModel:
    """Train on windows (windows, LENGTH) by Adam; equal inputs give equal weights."""
    rng = np.random.default_rng(seed)
    k = len(languages)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    w = {
        "ahead": normal(3, PAD + 1, STATE, scale=0.3),
        "behind": normal(3, PAD + 1, STATE, scale=0.3),
        "ahead_u": normal(3, STATE, STATE, scale=STATE**-0.5),
        "behind_u": normal(3, STATE, STATE, scale=STATE**-0.5),
        "out_a": normal(STATE, k, scale=STATE**-0.5),
        "out_b": normal(STATE, k, scale=STATE**-0.5),
        "bias": np.zeros(k, dtype=np.float32),
    }
    mean, square = ({name: np.zeros_like(v) for name, v in w.items()} for _ in range(2))
    per_language = [np.flatnonzero(labels == i) for i in range(k)]
    for step in range(1, steps + 1):
        # As many windows of each language, so a rare one is not drowned out.
        rows = np.concatenate([rng.choice(own, -(-TRAIN_BATCH // k)) for own in per_language])
        batch = np.ascontiguousarray(windows[rows].T)
        ahead, kept_a = _run(batch, w["ahead"], w["ahead_u"], keep=True)
        behind, kept_b = _run(batch[::-1], w["behind"], w["behind_u"], keep=True)
        ordered = behind[::-1]
        error = _softmax(_scores(w, ahead, ordered))
        error[:, np.arange(len(rows)), labels[rows]] -= 1
        seen = (batch < PAD)[:, :, None]
        error = np.where(seen, error, 0).astype(np.float32) / max(1, seen.sum())
        grads = {
            "out_a": ahead.reshape(-1, STATE).T @ error.reshape(-1, k),
            "out_b": ordered.reshape(-1, STATE).T @ error.reshape(-1, k),
            "bias": error.sum(axis=(0, 1)),
        }
        grads["ahead"], grads["ahead_u"] = _back(batch, w["ahead_u"], kept_a, error @ w["out_a"].T)
        grads["behind"], grads["behind_u"] = _back(batch[::-1], w["behind_u"], kept_b, (error @ w["out_b"].T)[::-1])
        for name, g in grads.items():
            g = np.clip(g, -1, 1)
            mean[name] = 0.9 * mean[name] + 0.1 * g
            square[name] = 0.99 * square[name] + 0.01 * g * g
            scale = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
            w[name] -= scale * (mean[name] / (1 - 0.9**step)) / (np.sqrt(square[name] / (1 - 0.99**step)) + 1e-8)
    return LanguageModel(languages, w)


# --- what no learned language looks like ---------------------------------------

_SYMBOLS, _DIGIT = 128, ord("0")


def _folded() -> np.ndarray:
    """Bytes as 128 symbols: letters without case, one blank, one digit, lead bytes as two, others apart."""
    out = np.arange(256)
    out[:32] = 32
    out[65:91] += 32
    out[48:58] = _DIGIT
    free = [c for c in range(_SYMBOLS) if c not in set(out[:128].tolist())]
    out[128:192] = free[:64]
    out[192:] = free[64]
    out[195] = free[65]
    return out


_FOLD = _folded()


@dataclass(frozen=True)
class Usual:
    """How likely bytes follow two others in what was learned, and how unlikely a text may be.

    The network tells languages apart, whatever it is given; this tells a text in
    none of them. ``table`` has the logarithm for every three symbols, and
    ``limits`` the least mean of a text by its length in bytes.
    """

    table: np.ndarray
    limits: tuple[tuple[int, float], ...]

    def mean(self, raw: bytes) -> tuple[float, int]:
        """Mean over the places of three symbols without a digit, and their number.

        A key or a number is in no language, so it says nothing of the text around it.
        """
        total, n = 0.0, 0
        for steps in self.steps(raw):
            total += float(steps.sum(dtype=np.float64))
            n += len(steps)
        return total / max(1, n), n

    def steps(self, raw: bytes) -> Iterator[np.ndarray]:
        """The logarithms that ``mean`` is of, long texts part by part."""
        s = _FOLD[np.frombuffer(raw, dtype=np.uint8)]
        for at in range(0, max(0, len(s) - 2), 1_000_000):
            a, b, c = (s[at + k : min(at + 1_000_000, len(s) - 2) + k] for k in range(3))
            counted = (a != _DIGIT) & (b != _DIGIT) & (c != _DIGIT)
            yield self.table[((a * _SYMBOLS + b) * _SYMBOLS + c)[counted]]

    def knows(self, text: str) -> bool:
        mean, counted = self.mean(text.encode("utf-8", "surrogatepass"))
        limit = next((least for n, least in reversed(self.limits) if counted + 2 >= n), None)
        return limit is None or mean >= limit


def _counts(windows: list[bytes]) -> np.ndarray:
    """How often each symbol follows each two: (first, second, third)."""
    n = _SYMBOLS
    three = np.zeros(n**3)
    for raw in windows:
        s = _FOLD[np.frombuffer(raw, dtype=np.uint8)]
        np.add.at(three, (s[:-2] * n + s[1:-1]) * n + s[2:], 1)
    return three.reshape(n, n, n)


def _smoothed(three: np.ndarray) -> np.ndarray:
    """Logarithms of the probability of a symbol after two, smoothed by that after one and alone."""
    n = _SYMBOLS
    two = three.sum(axis=0)
    one = two.sum(axis=0)
    p = (one + 0.01) / (one.sum() + 0.01 * n)
    p = (two + 5 * p) / (two.sum(axis=1, keepdims=True) + 5)
    p = (three + 5 * p) / (three.sum(axis=2, keepdims=True) + 5)
    return np.log(p).astype(np.float32).ravel()


def _likely(windows: list[bytes]) -> np.ndarray:
    return _smoothed(_counts(windows))


def _reach(means: np.ndarray, n: int, deviation: float) -> float:
    """How far below the median the end of what is usual lies, for texts of ``n`` bytes.

    Few windows do not show the rarest. Their lowest is then taken for what the
    lowest of so many is in a normal distribution, and the distance is never less
    than chance gives a mean of so many steps that deviate by ``deviation``, more
    by ``FEW`` over the number of windows.
    """
    seen = float(np.median(means)) - float(np.quantile(means, RARE))
    if len(means) >= LEAST_HELD:
        return seen
    z = NormalDist().inv_cdf
    by_chance = -z(RARE) * deviation / (n - 2) ** 0.5
    return max(seen * z(RARE) / z(1 / (len(means) + 1)), by_chance * (1 + FEW / len(means)))


def learn_usual(windows: list[bytes]) -> Usual | None:
    """Counts over all windows, and limits from all, each judged by counts that it is held back from.

    A limit lies below the median by a multiple of the distance of the rarest
    windows, each cut to the length that the limit is for. Any number of windows
    from two different ones on gives limits, few give wide ones; None where no
    two have the bytes of the least length. Equal windows are held back together.
    """
    unlike = list(dict.fromkeys(w for w in windows if len(w) >= LENGTHS[0]))
    if len(unlike) < 2:
        return None
    number = {w: i % FOLDS for i, w in enumerate(unlike)}
    folds = [[w for w in windows if number.get(w, 0) == k] for k in range(FOLDS)]
    counts = [_counts(fold) for fold in folds]
    three = sum(counts)
    means: dict[int, list[float]] = {n: [] for n in LENGTHS}
    steps = []
    for own, fold in zip(counts, folds):
        others = Usual(_smoothed(three - own), ())
        for w in fold:
            steps += others.steps(w)
            for n in LENGTHS:
                if len(w) >= n:
                    means[n].append(others.mean(w[:n])[0])
    deviation = float(np.concatenate(steps).std())
    limits = []
    for n, found in means.items():
        if len(found) > 1:
            limits.append((n, float(np.median(found)) - BEYOND * _reach(np.array(found), n, deviation)))
    return Usual(_smoothed(three), tuple(limits))


# --- on tables ----------------------------------------------------------------


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3: the fold of a document; 1 is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def train(
    labelled: DataFrame,
    sample_documents: int = SAMPLE_DOCUMENTS,
    sample_windows: int = SAMPLE_WINDOWS,
    steps: int = STEPS,
    seed: int = 11,
) -> LanguageModel | None:
    """A model of every language in ``labelled (doc_id, text, lang)``; None if there is none.

    Per language, the documents with the smallest hashes of their ids are taken,
    about ``sample_documents``, and of each ``sample_windows`` windows spread
    over the whole text; never more windows than the product of the three.
    """
    place = F.xxhash64(F.col("doc_id"), F.lit(seed))
    with_text = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # A row per language.
    sizes = sorted(with_text.groupBy(F.col("lang").cast("string")).count().collect())
    if not sizes:
        return None
    languages = tuple(lang for lang, _ in sizes)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: tuple[list, list] = ([], [])
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                windows = split(text)
                at = np.unique(np.linspace(0, len(windows) - 1, sample_windows).astype(int))
                for row in windows[at]:
                    out[0].append(lang)
                    out[1].append(row[row < PAD].astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.binary())], ["lang", "bytes"])

    chosen = F.lit(False)
    for lang, n in sizes:
        chosen = chosen | ((F.col("lang") == lang) & sampled(place, sample_documents, n))
    sample = with_text.filter(chosen).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string"))
    cuts = sample.mapInArrow(cut, "lang string, bytes binary")
    bound = len(languages) * sample_documents * sample_windows
    rows = cuts.orderBy(F.xxhash64("bytes", F.lit(seed)), "bytes", "lang").limit(bound).collect()
    windows = np.full((len(rows), LENGTH), PAD, dtype=np.int16)
    for i, r in enumerate(rows):
        windows[i, : len(r.bytes)] = np.frombuffer(bytes(r.bytes), dtype=np.uint8)
    number = {lang: i for i, lang in enumerate(languages)}
    labels = np.array([number[r.lang] for r in rows])
    model = fit(windows, labels, languages, steps, seed)
    return replace(model, usual=learn_usual([bytes(r.bytes) for r in rows]))


def predictions(texts: list[str | None], model: LanguageModel | None) -> list[tuple[str, float]]:
    """(language, mean probability); unknown with 0 for texts without a letter."""
    out = [(UNKNOWN, 0.0)] * len(texts)
    rows = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
    if model and rows:
        p = model.documents([texts[i] for i in rows])
        for i, best, score in zip(rows, p.argmax(axis=1).tolist(), p.max(axis=1).tolist()):
            out[i] = (model.languages[best], min(1.0, score))
    return out


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row.

    A missing text, one without letters, or a model that has learned nothing
    gives ``und`` with score 0. Ties go to the first language by name. Repeated
    rows are predicted alike, an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = predictions(batch.column(1).to_pylist(), model)
            langs = pa.array([x[0] for x in found], pa.string())
            scores = pa.array([x[1] for x in found], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), langs, scores], ["doc_id", "lang_pred", "score"])

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: LanguageModel | None, over_even: float = LEAST_OVER_EVEN) -> DataFrame:
    """``docs`` without rows whose language is unknown, unsure or none of the learned; columns as they are.

    Rows without a text or a letter go. So do texts whose bytes follow each other
    in ways that no learned text's do (see ``Usual``); a text of under eight
    bytes is too short to tell. Repeated rows are judged alike.
    """
    at = docs.columns.index("text")
    # With one language there is no doubt to measure.
    least = over_even / len(model.languages) if model and len(model.languages) > 1 else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(at).to_pylist()
            usual = model.usual if model else None
            known = [
                lang != UNKNOWN and p >= least and (usual is None or usual.knows(text))
                for (lang, p), text in zip(predictions(texts, model), texts)
            ]
            yield batch.filter(pa.array(known, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
