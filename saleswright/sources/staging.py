"""Written intermediates: build once, read many times."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..session import forget_local_dir, shuffles_dropped, working_dir
from .tables import publish, read_sales, write_sales

# What has been built in this process, by path; forgotten when it is deleted.
_written: dict[str, StructType] = {}
_made: set[str] = set()


def _state(spark: SparkSession, source: str) -> str:
    """Names, sizes and times of the files below ``source``, if it is a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(source)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return ""
    found, files = [], system.listFiles(path, True)
    while files.hasNext():
        f = files.next()
        found.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return "\n".join(sorted(found))


def staging_path(spark: SparkSession, source: str, name: str) -> str | None:
    """Where an intermediate of this application lies; None without a shared folder.

    The path changes with the files of ``source``, so what was made from other
    ones is not taken for current.
    """
    root = working_dir(spark)
    if root is None:
        return None
    tag = hashlib.sha256(f"{source}\n{_state(spark, source)}".encode()).hexdigest()[:12]
    return f"{root}/saleswright/{spark.sparkContext.applicationId}/{tag}/{name}"


def staged(spark: SparkSession, source: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Sales built by ``build``, written on first use and read back after.

    Many queries share one cleaned table. A written one outlives executors,
    prunes columns and skips years. ``build`` ends in tasks of a fair size, as
    after a shuffle; each writes its rows by year. Without a shared folder the plan stays
    lazy and is computed by each query.
    """
    path = staging_path(spark, source, name)
    if path is None:
        return build()
    if path not in _written:
        sales = build()
        write_sales(sales, path, gather=False)
        _written[path] = publish(sales).schema
    return read_sales(spark, path, _written[path])


def made_once(path: str, make: Callable[[], object]) -> None:
    """Call ``make``, which fills ``path``, unless that was done already."""
    if path not in _made:
        make()
        _made.add(path)


@contextmanager
def written_once(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` from a written copy while the block runs; the copy goes after it."""
    spark = df.sparkSession
    path = staging_path(spark, uuid.uuid4().hex, "once")
    if path is None:
        yield df
        return
    with shuffles_dropped(spark):
        df.write.mode("overwrite").parquet(path)
    try:
        yield spark.read.parquet(path)
    finally:
        drop_path(spark, path)


def drop_staged(spark: SparkSession) -> None:
    """Delete all intermediates of this application."""
    root = working_dir(spark)
    if root is not None:
        own = f"{root}/saleswright/{spark.sparkContext.applicationId}"
        drop_path(spark, own)
        for path in [p for p in _written if p.startswith(f"{own}/")]:
            del _written[path]
        _made.difference_update([p for p in _made if p.startswith(f"{own}/")])
        forget_local_dir(spark)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete an intermediate, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
