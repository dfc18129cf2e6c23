"""Session settings the plans rely on, and the shared working folder."""

from __future__ import annotations

import re
import shutil
import tempfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings every plan assumes. A join that feeds a window on the same
# key is only split when it is skewed if the "force" setting is on.
# Text that is no number or date has to raise, whatever the caller's session says.
RUNTIME_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # A write by year keeps a file open per year and does not sort its wide rows.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}

#: Bytes of source files to a shuffle partition, where narrow columnar files are joined to wide rows:
#: a partition's rows take some 25 times that in memory, and a task sorts them there.
JOINED_BYTES = 16 << 20
#: Most bytes of files that a task reads: rows of compressed text take some 15 times that when they are sorted.
READ_BYTES = 32 << 20
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_dirs: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session the caller built."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str | int = "*", app: str = "saleswright", **conf: str) -> SparkSession:
    """A single-JVM session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shuffle_partitions(input_bytes: int, target_bytes: int = 512 << 20, cores: int = 1) -> int:
    """Shuffle partitions that keep each near ``target_bytes``.

    AQE merges small partitions but never adds any, so the starting number has
    to fit the input: 100 TB at 512 MB gives about 200,000.
    """
    return max(cores, -(-input_bytes // target_bytes))


def sized(spark: SparkSession, paths: Iterable[str], target_bytes: int = JOINED_BYTES) -> SparkSession:
    """The session with shuffle partitions that fit the files at ``paths``, and reads of ``READ_BYTES`` at most.

    Partitions are more than before, or as many, reads smaller or as large. What does not fit
    in the memory of a task is written to disk once more by every sort.
    """
    size = 0
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        size += target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()
    fitting, key = shuffle_partitions(size, target_bytes), "spark.sql.shuffle.partitions"
    if fitting > int(spark.conf.get(key)):
        spark.conf.set(key, str(fitting))
    key = "spark.sql.files.maxPartitionBytes"
    if _bytes(spark.conf.get(key)) > READ_BYTES:
        spark.conf.set(key, str(READ_BYTES))
    return spark


def _bytes(setting: str) -> int:
    """A size as Spark writes it, such as ``128m`` or ``134217728b``."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", setting.strip().lower()).groups()
    return int(number) << 10 * (" kmgtp".index(unit) if unit else 0)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes in the block go when each write ends.

    Otherwise they stay until the driver's garbage is collected, so those of one write
    take up disk beside the next. Only for writes: a frame that is run again would make its
    shuffles anew.
    """
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def working_dir(spark: SparkSession) -> str | None:
    """Shared folder for written intermediates, or None when there is none.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session,
    where driver and executors are one process, falls back to a temporary one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        return None
    if sc.applicationId not in _local_dirs:
        _local_dirs[sc.applicationId] = tempfile.mkdtemp(prefix="saleswright-")
    return _local_dirs[sc.applicationId]


def forget_local_dir(spark: SparkSession) -> None:
    """Remove the temporary folder of a local session, checkpoints included."""
    folder = _local_dirs.pop(spark.sparkContext.applicationId, None)
    if folder is not None:
        shutil.rmtree(folder, ignore_errors=True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point ``DataFrame.checkpoint`` at the shared folder if nothing else has."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = working_dir(spark)
        if folder is None:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(folder)
