"""Sales that arrive in batches: the first row of each order across all of them.

Keys of orders seen so far lie in a table bucketed by key. A new batch is first
brought to one row per key, then sent to the buckets and joined there; the
stored side is read in place. Keys and cleaned rows of a batch count from the
moment its version is committed: a run that fails leaves both as they were, and
what it wrote is never looked at.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import clean_unique
from ..operators.dedupe import keep_first
from ..schema import SEQUENCE
from .staging import written_once
from .tables import publish, read_sales
from .versions import current, new_version

BUCKETS = 64
# A noncharacter set aside for internal use: the key of orders without an id.
NO_ID = "﷑"
_RUN, _KEY = "run", "order_key"


class BatchStore:
    """Cleaned sales under ``path``, one folder per batch, and the keys they came from.

    ``table`` names the key table in the catalog; it is made again from its
    files where a new session does not know it. The number of buckets stays
    what it was when the first batch came.
    """

    def __init__(self, spark: SparkSession, path: str, table: str | None = None, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.table = table or "kept_keys_" + hashlib.md5(self.path.encode()).hexdigest()[:12]

    def _runs(self) -> list[str]:
        """The runs that count, in order: one name per batch."""
        version = current(self.spark, self.path)
        if version is None:
            return []
        return [r.run for r in self.spark.read.parquet(f"{version.folder}/runs").orderBy("number").collect()]

    def _keys(self, runs: list[str]) -> DataFrame:
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({_KEY} STRING, {_RUN} STRING) USING parquet "
            f"CLUSTERED BY ({_KEY}) SORTED BY ({_KEY}) INTO {self.buckets} BUCKETS LOCATION '{self.path}/keys'"
        )
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table).filter(F.col(_RUN).isin(runs)).select(_KEY)

    def first_rows(self, raw: DataFrame, runs: list[str] | None = None) -> DataFrame:
        """The rows of a batch that are the first of their order, with their ``order_key`` and without their place."""
        keyed = raw.withColumn(_KEY, self._key())
        # A key that fills the batch is cut to one row per task before anything moves.
        first = keep_first(keyed, [_KEY]).drop(SEQUENCE).repartition(self.buckets, _KEY)
        # An anti-join would be moved ahead of the buckets, and then move the stored side.
        known = self._keys(self._runs() if runs is None else runs).withColumn("_known", F.lit(True))
        return first.join(known.hint("merge"), _KEY, "left").filter("_known IS NULL").drop("_known")

    @staticmethod
    def _key() -> Column:
        return F.coalesce(F.col("order_id"), F.lit(NO_ID))

    def add(self, raw: DataFrame) -> None:
        """Keep the first rows of a batch that comes after all before, then clean them.

        Invalid rows go after that, so one whose order is known hides later ones.
        """
        with new_version(self.spark, self.path) as version:
            runs = self._runs()
            run = version.folder.rsplit("/", 1)[1]
            with written_once(self.first_rows(raw, runs)) as first:
                keys = first.select(_KEY, F.lit(run).alias(_RUN))
                keys.write.mode("append").bucketBy(self.buckets, _KEY).sortBy(_KEY).format("parquet").saveAsTable(self.table)
                # Rows stay where the written copy has them: by year, all would move once more.
                publish(clean_unique(first.drop(_KEY))).write.parquet(f"{self.path}/sales/{run}")
            rows = list(enumerate([*runs, run], 1))
            self.spark.createDataFrame(rows, "number int, run string").coalesce(1).write.parquet(f"{version.folder}/runs")

    def sales(self) -> DataFrame:
        """The cleaned rows of all batches."""
        runs = self._runs()
        if not runs:
            raise FileNotFoundError(f"no batch at {self.path}")
        parts = [read_sales(self.spark, f"{self.path}/sales/{run}") for run in runs]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part, allowMissingColumns=True)
        return rows
