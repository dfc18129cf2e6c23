"""Results for clients: computed once, counted, and read page by page.

A result is written in its order as JSON records, each with its place: the
partition of the range sort, then the row. Counting and paging read what was
written, and a page only the files that hold it. The work runs under a tag, by
which it can be cancelled from another thread.
"""

from __future__ import annotations

import uuid
from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import drop_path, staging_path
from .marts import json_records

_AT = "_at"
_ROW_BITS = 33


@dataclass(frozen=True)
class Served:
    """A stored result: its columns, its number of records, and where its partitions start."""

    spark: SparkSession
    folder: str
    columns: list[str]
    parts: list[int]
    starts: list[int]
    count: int

    def page(self, first: int, size: int) -> DataFrame:
        """The records from number ``first`` (from 0) on, ``size`` at most, in order."""
        if first < 0 or size < 0:
            raise ValueError("a page starts at 0 or later and has no negative size")
        rows = self.spark.read.parquet(self.folder)
        low, high = self._place(first), self._place(min(first + size, self.count))
        return rows.filter((F.col(_AT) >= low) & (F.col(_AT) < high)).orderBy(_AT).select("record")

    def _place(self, number: int) -> int:
        """The place of a record by its number; beyond the last, one after all."""
        if number >= self.count:
            return (self.parts[-1] + 1 << _ROW_BITS) if self.parts else 0
        k = bisect_right(self.starts, number) - 1
        return (self.parts[k] << _ROW_BITS) + number - self.starts[k]

    def close(self) -> None:
        """Delete what was stored."""
        drop_path(self.spark, self.folder)


def serve(df: DataFrame, tag: str | None = None) -> Served:
    """Compute ``df`` once and store its records in its order.

    Nulls are shown, NaN is null, dates are in ISO form. ``cancel`` with the
    same ``tag`` stops it; what was written until then goes.
    """
    spark = df.sparkSession
    folder = staging_path(spark, uuid.uuid4().hex, "served")
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    tag = tag or f"served-{uuid.uuid4().hex}"
    spark.sparkContext.addJobTag(tag)
    try:
        json_records(df).withColumn(_AT, F.monotonically_increasing_id()).write.parquet(folder)
        part = F.shiftright(_AT, _ROW_BITS).alias("part")
        # One row per partition of the result.
        sizes = spark.read.parquet(folder).groupBy(part).count().orderBy("part").collect()
    except BaseException:
        drop_path(spark, folder)
        raise
    finally:
        spark.sparkContext.removeJobTag(tag)
    ends = list(accumulate((r["count"] for r in sizes), initial=0))
    return Served(spark, folder, df.columns, [r.part for r in sizes], ends[:-1], ends[-1])


def cancel(spark: SparkSession, tag: str) -> None:
    """Stop what runs under a tag."""
    spark.sparkContext.cancelJobsWithTag(tag)
