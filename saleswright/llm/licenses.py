"""Licences of files: TF-IDF cosine to templates, then inheritance by folder.

Lines, paragraphs and sentences that speak of a licence, however long, are
compared with the templates as sparse vectors, one row per term, weighted over
all such passages of the corpus. A passage that occurs in many files is scored
once. Beside these whole units, every paragraph gives, around its key words,
every window of as many words as a template has; windows are weighted like the
passages. A file has the licence of its best passage. A folder has that of the licence files in it, and files
without a licence of their own take that of the nearest folder above them: the
distinct folders are unrolled into their ancestors and joined to the licensed
ones, so a folder that holds a third of all files is one row there.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fixed, slices

#: Least cosine of a passage to a template.
LEAST = 0.6
# Names of licence files, words that a passage has to have, terms.
LICENSE_FILE = r"(?i)(^|/)(un)?(licen[sc]e|copying|notice)[^/]*$"
KEY = r"(?i)licen[sc]|copyleft|public domain|spdx|permission is hereby granted|redistribution and use"
TERM = r"[a-z]+|[0-9]+(?:[.][0-9]+)*"

# What licences say of themselves, by their usual short names.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "The MIT License (MIT)",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Apache License Version 2.0, January 2004",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "GNU General Public License Version 2, June 1991",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "GNU General Public License Version 3, 29 June 2007",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License.",
    ),
    "LGPL-3.0": (
        "Licensed under the GNU Lesser General Public License, version 3.",
        "GNU Lesser General Public License Version 3, 29 June 2007",
    ),
    "AGPL-3.0": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "GNU Affero General Public License Version 3, 19 November 2007",
    ),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.", "Simplified BSD License"),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, Version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "ISC": ("Licensed under the ISC License.",),
    "EPL-2.0": ("Licensed under the Eclipse Public License, version 2.0.",),
    "Unlicense": ("Released into the public domain under the Unlicense.",),
    "CC0-1.0": ("Licensed under CC0 1.0.", "Creative Commons Zero 1.0 Universal public domain dedication license"),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-ND-4.0": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
}


_LENGTHS = sorted({len(re.findall(TERM, body.lower())) for bodies in TEMPLATES.values() for body in bodies})
#: Most words of a stretch; longer ones are cut into several that share what one window needs.
STRETCH = 4 * _LENGTHS[-1]
#: Key words with any blanks, line ends or comment marks between.
SPREAD_KEY = KEY.replace(" ", "[^a-z0-9]+")
_KEY, _SPREAD_KEY = re.compile(KEY, re.A), re.compile(SPREAD_KEY, re.A)


def _key_words(words: list[str]) -> list[tuple[int, int]]:
    """First and last word of every key word or phrase."""
    starts, at = [], 0
    for w in words:
        starts.append(at)
        at += len(w) + 1
    return [(bisect_right(starts, m.start()) - 1, bisect_right(starts, m.end() - 1) - 1) for m in _KEY.finditer(" ".join(words))]


def stretches(text: str) -> set[str]:
    """Words around key words, from which windows are cut.

    Every run of a template's length that holds a key word, in a paragraph of
    any length, lies in one stretch; so does the whole of a shorter paragraph.
    """
    most, out = _LENGTHS[-1], set()
    for unit in re.split(r"\n[ \t\r]*\n", text):
        if not _SPREAD_KEY.search(unit):
            continue
        words = re.findall(TERM, unit.lower())
        spans: list[list[int]] = []
        for first, last in _key_words(words):
            a, b = max(0, last + 1 - most), min(len(words), first + most)
            if spans and a <= spans[-1][1]:
                spans[-1][1] = max(b, spans[-1][1])
            else:
                spans.append([a, b])
        for a, b in spans:
            for at in range(a, max(a + 1, b - most + 1), STRETCH - most + 1):
                out.add(" ".join(words[at : min(b, at + STRETCH)]))
    return {words for words in out if _KEY.search(words)}


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = [(p, h, s) for p, h, t in zip(*(c.to_pylist() for c in batch.columns)) for s in sorted(stretches(t))]
        kinds = (pa.string(), pa.int64(), pa.string())
        columns = [pa.array(c, kind) for c, kind in zip(list(zip(*rows)) or [()] * 3, kinds)]
        yield pa.RecordBatch.from_arrays(columns, ["_lic_path", "_lic_hash", "passage"])


def passages(text: Column) -> Column:
    """Distinct lines, paragraphs and sentences of a text that speak of a licence, of any length."""
    paragraphs = F.split(text, r"\n[ \t\r]*\n")
    sentences = F.flatten(F.transform(paragraphs, lambda u: F.split(u, r"(?<=[.!?;])\s+")))
    speaking = F.filter(F.concat(F.split(text, "\n"), paragraphs, sentences), lambda u: u.rlike(SPREAD_KEY))
    folded = F.transform(speaking, lambda u: F.array_join(F.regexp_extract_all(F.lower(u), F.lit(TERM), F.lit(0)), " "))
    found = F.when(text.rlike(SPREAD_KEY), F.array_distinct(F.filter(folded, lambda u: u.rlike(KEY))))
    return F.coalesce(found, F.array().cast("array<string>"))


def _terms(rows: DataFrame, key: str, text: str) -> DataFrame:
    """``key, term, tf``: how often a term occurs, on a logarithmic scale.

    The key is short; a passage itself would be repeated with each of its terms.
    """
    return (
        rows.select(key, F.explode(F.split(text, " ")).alias("term"))
        .groupBy(key, "term")
        .agg((1 + F.log(F.count(F.lit(1)))).alias("tf"))
    )


def _bodies() -> list[tuple[str, Counter]]:
    """(licence, term counts) of every template."""
    return [(name, Counter(re.findall(TERM, body.lower()))) for name, bodies in TEMPLATES.items() for body in bodies]


def inverse(n: int, count: int) -> float:
    """Inverse document frequency of a term in ``count`` of ``n`` passages."""
    return math.log((1 + n) / (1 + count)) + 1


class Weights:
    """Inverse document frequencies over passages and templates, and the templates' vectors."""

    def __init__(self, found: DataFrame):
        self.bodies = _bodies()
        in_templates = Counter(term for _, counts in self.bodies for term in counts)
        terms = pa.table({"term": list(in_templates), "n_templates": list(in_templates.values())})
        fixed_terms = found.sparkSession.createDataFrame(terms)
        self.n = found.count() + len(self.bodies)
        self.own = _terms(found, "passage_id", "passage")
        in_passages = self.own.groupBy("term").agg(F.count(F.lit(1)).alias("n_passages"))
        self.df = fixed(
            in_passages.join(F.broadcast(fixed_terms), "term", "left").select(
                "term", (F.col("n_passages") + F.coalesce("n_templates", F.lit(0))).alias("df")
            )
        )
        known = dict(in_templates) | {r.term: r.df for r in self.df.filter(F.col("term").isin(list(in_templates))).collect()}
        self.idf = {term: inverse(self.n, count) for term, count in known.items()}
        self.vectors: dict[str, list[float]] = {term: [0.0] * len(self.bodies) for term in in_templates}
        for i, (_, counts) in enumerate(self.bodies):
            own_weights = {t: (1 + math.log(c)) * self.idf[t] for t, c in counts.items()}
            length = math.sqrt(sum(w * w for w in own_weights.values()))
            for t, w in own_weights.items():
                self.vectors[t][i] = w / length


def score(found: DataFrame, weights: Weights, least: float = LEAST) -> DataFrame:
    """``passage_id, license, cosine`` of distinct passages close to a template.

    Document frequencies count the distinct passages and the templates. Equal
    cosines go to the first licence by name. The templates are one array of
    weights per term they use, so all cosines of a passage are sums of one pass.
    """
    bodies, n = weights.bodies, weights.n
    vectors = found.sparkSession.createDataFrame(pa.table({"term": list(weights.vectors), "v": list(weights.vectors.values())}))
    weighted = weights.own.join(
        weights.df.select("term", (F.log((1 + F.lit(n)) / (1 + F.col("df"))) + 1).alias("idf")), "term"
    ).join(F.broadcast(vectors), "term", "left")  # a row per term of the templates
    w = F.col("tf") * F.col("idf")
    sums = weighted.groupBy("passage_id").agg(
        F.sqrt(F.sum(w * w)).alias("length"), *[F.sum(w * F.col("v")[i]).alias(f"dot{i}") for i in range(len(bodies))]
    )
    cosines = [
        F.struct((-F.round(F.coalesce(f"dot{i}", F.lit(0.0)) / F.col("length"), 6)).alias("far"), F.lit(name).alias("license"))
        for i, (name, _) in enumerate(bodies)
    ]
    best = sums.select("passage_id", F.array_min(F.array(*cosines)).alias("b"))
    return best.select("passage_id", "b.license", (-F.col("b.far")).alias("cosine")).filter(F.col("cosine") >= least)


def best_window(words: list[str], idf: dict[str, float], names: list[str], vectors: dict[str, list[float]]) -> tuple[float, str]:
    """(minus cosine, licence) of the best window with a key word in it."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    scale = np.array([idf[w] for w in number])
    templates = np.array([vectors.get(w) or [0.0] * len(names) for w in number])
    upto = np.zeros((len(words) + 1, len(number)))
    upto[np.arange(1, len(words) + 1), [number[w] for w in words]] = 1
    upto = upto.cumsum(axis=0)
    keys = _key_words(words)
    best = np.full(len(names), -1.0)
    for size in {min(n, len(words)) for n in _LENGTHS}:
        at = sorted({i for a, b in keys for i in range(max(0, b + 1 - size), min(a, len(words) - size) + 1)})
        if not at:
            continue
        counts = upto[np.array(at) + size] - upto[at]
        w = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * scale
        best = np.maximum(best, (w @ templates / np.sqrt((w * w).sum(axis=1))[:, None]).max(axis=0))
    return min((-round(float(c), 6), name) for c, name in zip(best, names))


def score_stretches(found: DataFrame, weights: Weights, least: float = LEAST) -> DataFrame:
    """``passage_id, license, cosine`` of distinct stretches with a window close to a template.

    Frequencies of the templates' terms travel with the code; only other terms
    are joined, so the words that every stretch has are in no join.
    """
    known, vectors, names, n = weights.idf, weights.vectors, [name for name, _ in weights.bodies], weights.n
    others = (
        found.select("passage_id", F.explode(F.array_distinct(F.split("passage", " "))).alias("term"))
        .filter(~F.col("term").isin(list(known)))
        .join(weights.df, "term")
        .groupBy("passage_id")
        .agg(F.collect_list(F.struct("term", "df")).alias("terms"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for key, text, terms in zip(*(c.to_pylist() for c in batch.columns)):
                words = text.split(" ")
                idf = dict.fromkeys(words, inverse(n, 0)) | known | {t["term"]: inverse(n, t["df"]) for t in terms or ()}
                far, name = best_window(words, idf, names, vectors)
                if -far >= least:
                    rows.append((key, name, -far))
            kinds = (pa.string(), pa.string(), pa.float64())
            columns = [pa.array(c, kind) for c, kind in zip(list(zip(*rows)) or [()] * 3, kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["passage_id", "license", "cosine"])

    joined = found.join(others, "passage_id", "left").select("passage_id", "passage", "terms")
    return joined.mapInArrow(run, "passage_id string, license string, cosine double")


def _folder(path: Column) -> Column:
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.lit(""))


def scan_licenses(files: DataFrame, least: float = LEAST) -> DataFrame:
    """All columns of ``files`` but ``text``, with ``license, origin, cosine, folder``.

    ``files`` has ``path`` and ``text``. ``origin`` is ``own`` (a passage of the
    file), ``inherited`` (from ``folder``, the nearest one at or above the
    file's that has licence files) or ``none``. Of several licences the one with
    the highest cosine counts, then the first by name. A missing path counts as
    empty, a file in the root; a missing text has no passages; rows with equal
    path and text get equal results; an empty table gives no rows. Extra columns
    named like a result are replaced, all others stay.
    """
    results = ("license", "origin", "cosine", "folder")
    extra = [c for c in files.columns if c not in (*results, "text")]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = fixed(
        files.select(
            F.struct(*extra).alias("_lic_extra"),
            F.coalesce(F.col("path").cast("string"), F.lit("")).alias("_lic_path"),
            F.xxhash64(text).alias("_lic_hash"),
            passages(text).alias("_lic_passages"),
        )
    )
    said = rows.select("_lic_path", "_lic_hash", F.explode("_lic_passages").alias("passage"))
    said = said.withColumn("passage_id", F.md5("passage"))
    once = said.groupBy("passage_id").agg(F.min("passage").alias("passage"))
    once = fixed(once)
    weights = Weights(once)
    texts = files.select(
        F.coalesce(F.col("path").cast("string"), F.lit("")).alias("_lic_path"), F.xxhash64(text).alias("_lic_hash"), text.alias("text")
    ).filter(F.col("text").rlike(SPREAD_KEY))
    cut = texts.mapInArrow(_stretches, "_lic_path string, _lic_hash long, passage string")
    cut = fixed(cut.withColumn("passage_id", F.concat(F.lit("in "), F.md5("passage"))))
    cut_once = cut.groupBy("passage_id").agg(F.min("passage").alias("passage"))
    scored = score(once, weights, least).unionByName(score_stretches(cut_once, weights, least))
    keys = ("_lic_path", "_lic_hash", "passage_id")
    spread = said.select(*keys).unionByName(cut.select(*keys)).distinct()
    first = F.min(F.struct((-F.col("cosine")).alias("far"), "license")).alias("_b")
    own = fixed(
        spread.join(scored, "passage_id")
        .groupBy("_lic_path", "_lic_hash")
        .agg(first)
        .select("_lic_path", "_lic_hash", F.col("_b.license").alias("_own"), (-F.col("_b.far")).alias("_cosine"))
    )
    licensed = (
        own.filter(F.col("_lic_path").rlike(LICENSE_FILE))
        .select(_folder(F.col("_lic_path")).alias("_above"), F.col("_own").alias("license"), F.col("_cosine").alias("cosine"))
        .groupBy("_above")
        .agg(first)
        .select("_above", F.col("_b.license").alias("_given"), (-F.col("_b.far")).alias("_given_cosine"))
    )
    parts = F.split("_lic_folder", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(parts, 1, i), "/").alias("_above")))
    nearest = (
        rows.select(_folder(F.col("_lic_path")).alias("_lic_folder"))
        .distinct()
        .select("_lic_folder", F.inline(above))
        .join(licensed, "_above")
        .groupBy("_lic_folder")
        .agg(F.max(F.struct("depth", "_above", "_given", "_given_cosine")).alias("_near"))
    )
    joined = (
        rows.drop("_lic_passages")
        .withColumn("_lic_folder", _folder(F.col("_lic_path")))
        .join(own, ["_lic_path", "_lic_hash"], "left")
        .join(nearest, "_lic_folder", "left")
    )
    has_own, has_near = F.col("_own").isNotNull(), F.col("_near").isNotNull()
    return joined.select(
        *[F.col("_lic_extra")[c].alias(c) for c in extra],
        F.coalesce("_own", "_near._given").alias("license"),
        F.when(has_own, "own").when(has_near, "inherited").otherwise("none").alias("origin"),
        F.coalesce("_cosine", "_near._given_cosine").alias("cosine"),
        F.when(~has_own & has_near, F.col("_near._above")).alias("folder"),
    )
