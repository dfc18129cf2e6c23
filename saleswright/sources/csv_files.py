"""CSV in and out."""

from __future__ import annotations

import re
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import PUBLISHED_MARGIN, REQUIRED, SEQUENCE
from ..session import configure, shuffles_dropped
from .raw import DATES, conform
from .versions import swapped

#: Files whose header is read at a time; a header is some hundred bytes.
_READERS = 32
#: Characters that a path pattern would not take for themselves.
_GLOB = re.compile(r"([{}\[\]*?\\])")


def read_sales_csv(
    spark: SparkSession, path: str, multiline: bool = False, date_format: str = DATES
) -> DataFrame:
    """Raw sales with the position of each row in its file.

    Each file's own header names its columns, in whatever order; those that a
    file lacks are missing in its rows, but ``ValueError`` tells of a required
    one that only some files have. Files are grouped by header and scanned group
    by group. Values are read as text and typed by us: inference would cost a
    second pass and could differ between files. File, block and the rising id
    inside a block give the order of rows, across groups too, without any sort,
    and give it again on a retry. The raw margin is not kept; cleaning computes
    it anew. ``multiline`` allows line breaks inside quotes, at the price of one
    task per file. Dates are ISO, with or without a time; ``date_format`` names
    another form.
    """
    configure(spark)
    groups = files_by_header(spark, path)
    parts = [_scan(spark, names, files if len(groups) > 1 else path, multiline) for names, files in groups.items()]
    known = {name for names in groups for name in names}
    for names, files in groups.items():
        if lacking := [c for c in REQUIRED if c in known and c not in names]:
            raise ValueError(f"{files[0]} lacks {lacking}, which other files have")
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return conform(rows, date_format).drop(PUBLISHED_MARGIN)


def _scan(spark: SparkSession, names: tuple[str, ...], paths: str | list[str], multiline: bool) -> DataFrame:
    """The files of one header as text, with the position of each row."""
    rows = (
        spark.read.schema(T.StructType([T.StructField(name, T.StringType()) for name in names]))
        .option("header", True)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .option("multiLine", multiline)
        .csv(paths)
    )
    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return rows.withColumn(SEQUENCE, position)


def files_by_header(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files that ``path`` names, by their columns; files without a line are left out.

    First lines are read many files at a time, compressed ones through their
    codec. Spark parses each distinct line once.
    """
    to_path, to_uri = spark._jvm.org.apache.hadoop.fs.Path, spark._jvm.java.net.URI
    files = sorted(to_path(to_uri(file)).toString() for file in spark.read.text(path).inputFiles())
    with ThreadPoolExecutor(_READERS) as pool:
        lines = list(pool.map(lambda file: _first_line(spark, file), files))
    by_line: dict[str, list[str]] = defaultdict(list)
    for file, line in zip(files, lines):
        if line:
            by_line[line].append(_GLOB.sub(r"\\\1", file))
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for line, own in by_line.items():
        header = spark.read.option("header", True).option("escape", '"').csv(spark.sparkContext.parallelize([line], 1).map(str))
        groups[tuple(header.columns)] += own
    if not groups:
        raise ValueError(f"no header in {path}")
    return dict(groups)


def _first_line(spark: SparkSession, file: str) -> str:
    """The header of a file, over several lines if a quoted name has some; empty if there is none."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    stream = path.getFileSystem(conf).open(path)
    try:
        plain = codec.createInputStream(stream) if codec is not None else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8"))
        text = ""
        while (line := reader.readLine()) is not None:
            text += line
            if text.strip() and text.count('"') % 2 == 0:
                break
            text += "\n" if text.strip() else ""
        return text.removeprefix("\ufeff").strip("\r\n")
    finally:
        stream.close()


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """One CSV file with header per partition, replacing what was there as a whole; quotes are doubled.

    ``compression`` names a codec, such as ``gzip``; the files are read back by their ending.
    """
    with swapped(df.sparkSession, path) as folder, shuffles_dropped(df.sparkSession):
        df.write.option("header", True).option("escape", '"').csv(folder, compression=compression)
