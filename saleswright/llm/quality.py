"""Quality rules whose thresholds follow the data of each language and source.

Every document gets a few ratios. Per language and source, each ratio is
summarised by a quantile sketch: counts of values in buckets that grow by a
fixed factor, so any quantile is known to half a percent, and two sketches merge by
adding counts. Adding is what a grouped count does, map-side first, so a source
that holds a third of all rows sends one row per bucket and task. The sketches
of a language and of everything are merged from those of its sources. A range
ends at an upper quantile plus a multiple of its distance from the median, so a
source that varies more reaches further, and one that never varies not at all.
Nothing in it is fixed beforehand. Ranges are then joined to the documents, and
a document may lie outside by as much as a ratio over so few words or lines
varies by chance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fixed, slices

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: The ratios, with what each is counted over; a repeated window marks six words at once.
RATIOS = {"symbols": "n_words", "capitals": "word_chars", "dup_lines": "n_lines", "repeats": "n_words", "word_length": "n_words"}
WORDS_AT_ONCE = 6
#: The ratio that is a mean, not a share, and can also be too small.
MEAN = "word_length"
#: The quantile up to which documents are in range anyway, and how many spreads beyond.
UPPER = 0.85
REACH = 2.0
#: Standard errors a document may be outside, and of a mean the words' spread over their mean.
ERRORS = 2.0
VARIATION = 0.5
#: Rows a source (or language) needs for thresholds of its own.
MIN_ROWS = 100
GROWTH, TINY = 1.005, 1e-4

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_lines")


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    if len(numbers) == len(words):
        return 0
    pair = ids[:-2] * len(numbers) + ids[1:-1]
    if len(numbers) > 2_000_000:  # else three numbers fit into one
        pair = np.unique(pair, return_inverse=True)[1].astype(np.int64)
    window = pair * len(numbers) + ids[2:]
    order = np.argsort(window, kind="stable")
    same = window[order][1:] == window[order][:-1]
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    hit = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    edge[hit] += 1
    edge[hit + 3] -= 1
    return int(np.count_nonzero(np.cumsum(edge)))


def count_text(text: str | None) -> tuple[int, ...]:
    """The ``COUNTS`` of one whole text; a missing one has none."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    letters = np.frombuffer(raw, dtype=np.uint8)
    seen: set[str] = set()
    lines = repeats = 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            lines += 1
            repeats += line in seen
            seen.add(line)
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        repeats,
        repeated_words(words),
        int(np.count_nonzero((letters >= 65) & (letters <= 90))),
        lines,
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = [count_text(t) for t in batch.column("text").to_pylist()]
        columns = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * len(COUNTS)
        yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(3)] + columns, ["doc_id", "lang", "source", *COUNTS])


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source`` and the counts and ratios of every document."""
    schema = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS)
    counted = docs.select("doc_id", F.col("lang").cast("string"), F.col("source").cast("string"), F.col("text").cast("string"))

    def ratio(num: str, den: str) -> Column:
        return F.coalesce(F.try_divide(F.col(num).cast("double"), F.col(den)), F.lit(0.0))

    return counted.mapInArrow(_count, schema).withColumns(
        {
            "symbols": ratio("n_symbols", "n_words"),
            "capitals": ratio("n_capitals", "word_chars"),
            "dup_lines": ratio("n_dup_lines", "n_lines"),
            "repeats": ratio("n_repeat_words", "n_words"),
            "word_length": ratio("word_chars", "n_words"),
        }
    )


def sketches(measured: DataFrame) -> DataFrame:
    """``lang, source, measure, bucket, n``: the sketch of each source, as rows."""
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in RATIOS])
    bucket = F.when(F.col("value") > TINY, F.ceil(F.log(F.col("value") / TINY) / math.log(GROWTH)).cast("int")).otherwise(0)
    return (
        measured.select("lang", "source", F.inline(pairs))
        .groupBy("lang", "source", "measure", bucket.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merge(sketch: DataFrame, *keys: str) -> DataFrame:
    """Sketches added up over everything but ``keys``."""
    return sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, *keys: str) -> DataFrame:
    """``keys, measure, rows, lower, middle, upper``, right to half a percent of the value."""
    run = Window.partitionBy(*keys, "measure").orderBy("bucket")
    value = F.when(F.col("bucket") == 0, 0.0).otherwise(
        TINY * F.pow(F.lit(GROWTH), F.col("bucket")) * 2 / (1 + GROWTH)
    )
    steps = sketch.withColumns(
        {
            "_upto": F.sum("n").over(run),
            "_rows": F.sum("n").over(Window.partitionBy(*keys, "measure")),
            "_value": value,
        }
    )

    def at(q: float) -> Column:
        return F.min(F.when(F.col("_upto") >= F.col("_rows") * q, F.col("_value")))

    found = [at(1 - UPPER).alias("lower"), at(0.5).alias("middle"), at(UPPER).alias("upper")]
    return steps.groupBy(*keys, "measure").agg(F.max("_rows").alias("rows"), *found)


def fences(found: DataFrame, level: str, *keys: str) -> DataFrame:
    """One row per key with the range of each ratio, for keys with enough rows."""
    ranges = found.filter(F.col("rows") >= MIN_ROWS) if keys else found
    # Values of one bucket of the sketch count as equal.
    ranges = ranges.withColumns(
        {
            "low": (F.col("lower") - REACH * (F.col("middle") - F.col("lower"))) / GROWTH,
            "high": (F.col("upper") + REACH * (F.col("upper") - F.col("middle"))) * GROWTH,
        }
    )
    return ranges.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("measure") == m, F.struct("low", "high", "middle", "upper"))).alias(f"{level}_{m}")
            for m in RATIOS
        ]
    )


def by_chance(m: str, fence: Column) -> Column:
    """How far a document's ratio may be off from its source's, given what it is counted over.

    For a share p over n, the bound of a score interval: standard errors of p,
    and what p = 0 still allows. For a mean, its standard errors.
    """
    n = F.greatest(F.col(RATIOS[m]).cast("double"), F.lit(1.0))
    if m == MEAN:
        return ERRORS * VARIATION * fence["middle"] / F.sqrt(n)
    n = n / WORDS_AT_ONCE if m == "repeats" else n
    p = F.least(fence["upper"], F.lit(1.0))
    return ERRORS * F.sqrt(p * (1 - p) / n) + ERRORS**2 / (n + ERRORS**2)


def judge(measured: DataFrame) -> DataFrame:
    """``measured`` with ``base_failed``, ``in_range`` and ``kept``.

    ``base_failed``: fewer than 50 words, or over half of them in repeated
    three-word windows. ``in_range``: every ratio lies, but for chance, within
    the thresholds of the document's source in its language; with under 100 rows there, of its
    language; with under 100 rows there too, of all documents. A missing
    language or source is a group of its own. Equal rows are judged alike, an
    empty table gives no rows.
    """
    sketch = sketches(measured)
    by_lang = merge(sketch, "lang")
    overall = merge(by_lang)
    own = fences(quantiles(sketch, "lang", "source"), "s", "lang", "source")
    own = own.withColumnsRenamed({"lang": "_s_lang", "source": "_s_source"})
    lang_fences = fences(quantiles(by_lang, "lang"), "l", "lang").withColumnRenamed("lang", "_l_lang")
    joined = (
        measured.join(own, F.col("lang").eqNullSafe(F.col("_s_lang")) & F.col("source").eqNullSafe(F.col("_s_source")), "left")
        .join(lang_fences, F.col("lang").eqNullSafe(F.col("_l_lang")), "left")
        .join(fences(quantiles(overall), "a"), F.lit(True), "left")  # one row
    )

    def inside(m: str) -> Column:
        fence = F.coalesce(f"s_{m}", f"l_{m}", f"a_{m}")
        fits = F.col(m) <= fence["high"] + by_chance(m, fence)
        return fits & (F.col(m) >= fence["low"] - by_chance(m, fence)) if m == MEAN else fits

    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    in_range = F.lit(True)
    for m in RATIOS:
        in_range = in_range & inside(m)
    return joined.select(*measured.columns, base_failed.alias("base_failed"), in_range.alias("in_range")).withColumn(
        "kept", ~F.col("base_failed") & F.col("in_range")
    )


def quality(docs: DataFrame) -> DataFrame:
    """Counts, ratios and verdict of every document; see ``judge``."""
    return judge(fixed(measure(docs)))
