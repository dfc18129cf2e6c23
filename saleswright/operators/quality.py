"""Data-quality checks on raw sales. They report; they never change a row."""

from __future__ import annotations

import logging

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..schema import REQUIRED

log = logging.getLogger(__name__)


def check_columns(df: DataFrame) -> DataFrame:
    """The input itself, or ``ValueError`` naming what is missing."""
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        raise ValueError(f"the input lacks {missing}")
    return df


def _null_measures():
    return [F.count_if(F.col(c).isNull()).alias(c) for c in REQUIRED]


def null_counts(df: DataFrame) -> DataFrame:
    """``(column_name, n)`` for every required column, in one pass."""
    wide = check_columns(df).agg(*_null_measures())
    return wide.unpivot([], list(REQUIRED), "column_name", "n")


def issues(df: DataFrame) -> DataFrame:
    """``(check, column_name, n)`` for each problem found; no rows means clean.

    All counts come from a single aggregation. Duplicates are rows beyond the
    first per ``order_id``; wrapping the key in a struct keeps the null key in
    the distinct count. Tasks drop repeated keys before the shuffle.
    """
    distinct_keys = F.count_distinct(F.struct("order_id"))
    wide = check_columns(df).agg(
        *_null_measures(),
        F.count_if(F.col("sales") < 0).alias("_negative"),
        (F.count(F.lit(1)) - distinct_keys).alias("_duplicate"),
    )

    def row(check: str, column: str, n: str):
        return F.struct(F.lit(check).alias("check"), F.lit(column).alias("column_name"), F.col(n).alias("n"))

    found = [row("null", c, c) for c in REQUIRED]
    found += [row("negative", "sales", "_negative"), row("duplicate", "order_id", "_duplicate")]
    return wide.select(F.inline(F.array(*found))).filter("n > 0")


def validate(df: DataFrame) -> DataFrame:
    """Check, log what was found, and hand the input back untouched."""
    found = issues(df).collect()  # at most one row per check
    for row in found:
        log.warning("%s rows: %s in %s", row.n, row.check, row.column_name)
    log.info("validation complete, %d issues", len(found))
    return df


_PART, _FIRST = "_observed_part", "_observed_first"


def _counted(observation: Observation) -> dict | None:
    """What was observed; None where the plan was found empty and ran without the watch."""
    try:
        return observation.get
    except Py4JJavaError:
        return None


class Checks:
    """The same issues, counted while rows pass on their way to a write.

    ``seen`` watches raw rows, ``kept`` the first rows of each key; what one has
    more than the other are duplicates. Neither costs a scan or a shuffle. The
    counts are there once the write has ended.

    Spark counts the rows of a task again if the task is run again because an
    executor was lost. Therefore the tasks themselves are watched too, by the
    first row of each; if one was seen twice, ``found`` scans the input after all.
    """

    def __init__(self) -> None:
        self._seen, self._kept = Observation(), Observation()
        self._raw: DataFrame | None = None

    def seen(self, raw: DataFrame) -> DataFrame:
        self._raw = check_columns(raw)
        first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
        marked = raw.withColumns({_PART: F.spark_partition_id(), _FIRST: first})
        watched = marked.observe(
            self._seen,
            *_null_measures(),
            F.count_if(F.col("sales") < 0).alias("_negative"),
            F.count(F.lit(1)).alias("_rows"),
            F.count_if(_FIRST).alias("_tasks"),
            F.size(F.collect_set(F.when(F.col(_FIRST), F.col(_PART)))).alias("_parts"),
        )
        return watched.drop(_PART, _FIRST)

    def kept(self, first_rows: DataFrame) -> DataFrame:
        part, first = F.spark_partition_id(), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
        watched = first_rows.withColumns({_PART: part, _FIRST: first}).observe(
            self._kept,
            F.count(F.lit(1)).alias("_rows"),
            F.count_if(_FIRST).alias("_tasks"),
            F.size(F.collect_set(F.when(F.col(_FIRST), F.col(_PART)))).alias("_parts"),
        )
        return watched.drop(_PART, _FIRST)

    def found(self) -> list[tuple[str, str, int]]:
        """``(check, column_name, n)`` for each problem, after the write."""
        raw, kept = _counted(self._seen), _counted(self._kept)
        if not raw or not kept or raw["_tasks"] != raw["_parts"] or kept["_tasks"] != kept["_parts"]:
            log.info("rows were not watched once each; counting issues in a scan of their own")
            return [tuple(row) for row in issues(self._raw).collect()]  # at most one row per check
        rows = [("null", c, raw[c]) for c in REQUIRED]
        rows += [("negative", "sales", raw["_negative"]), ("duplicate", "order_id", raw["_rows"] - kept["_rows"])]
        return [row for row in rows if row[2] > 0]

    def report(self) -> None:
        """Log what was found."""
        found = self.found()
        for check, column, n in found:
            log.warning("%s rows: %s in %s", n, check, column)
        log.info("validation complete, %d issues", len(found))
