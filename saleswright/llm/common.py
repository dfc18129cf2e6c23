"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Rows whose texts a Python worker holds as objects at a time.
ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder.

    Used for narrow intermediates that several jobs read. Unlike a local
    checkpoint it outlives the executors that made it.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` starts with it."""
    taken = [c.lower() for c in df.columns]
    while any(c.startswith(name.lower()) for c in taken):
        name += "_"
    return name


def sampled(place: Column, wanted: int, total: int) -> Column:
    """Whether a 64-bit hash falls into the lowest part that holds ``wanted`` of ``total`` rows.

    That many are expected; no rows are sorted or gathered to find them. Where
    the bound must be strict, a limit on the few that remain follows.
    """
    if total <= wanted:
        return F.lit(True)
    return place <= F.lit(-(2**63) + wanted * 2**64 // total).cast("long")


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, without copying them."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
