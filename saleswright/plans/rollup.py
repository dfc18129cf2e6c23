"""KPI figures from a stored rollup of mergeable partial states.

One scan of a batch of sales gives, by grouping sets, the sums and counts that
every KPI is made of, per month, region and segment, sales rep, product and
pricing. Distinct customers can't be added up, so they are kept as exact bitmaps
over customer numbers, which a distributed pass deals out densely. A bitmap is
stored by words of 64 numbers, those without a bit left out: a group takes no
more rows than it has customers, however many others there are. Adding a batch
adds states and ORs bitmaps; sales stored before are not read again, and queries
read the rollup alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.measures import STATES, state_measures, state_sql
from ..session import ensure_checkpoint_dir
from ..sources.versions import current, new_version
from . import kpi
from .views import VIEWS

#: What sales are grouped by; every query reads one of these.
FACETS = {
    "month": ("order_year", "order_month"),
    "place": ("region", "segment"),
    "rep": ("sales_rep",),
    "product": ("product_name", "product_category"),
    "pricing": ("is_discounted",),
}
#: Facets for which distinct customers are asked.
COUNTED = ("month", "place", "rep")
KEYS = tuple(key for keys in FACETS.values() for key in keys)
_KINDS = {"order_year": "int", "order_month": "int", "is_discounted": "int"}
#: Types of what is stored, as a batch without rows leaves no file to tell them.
SCHEMAS = {
    "states": ", ".join(
        ["facet string", *(f"{k} {_KINDS.get(k, 'string')}" for k in KEYS), *(f"{c} {kind}" for c, (_, kind) in STATES.items())]
    ),
    "bitmaps": ", ".join(
        ["facet string", *(f"{k} {_KINDS.get(k, 'string')}" for f in COUNTED for k in FACETS[f]), "word long, bits long"]
    ),
}


def _grouped(rows: DataFrame, facets: Sequence[str], more: Sequence[str], *states: Column) -> DataFrame:
    """``rows`` grouped by each facet in one pass, told apart by ``facet``; other keys are null."""
    keys = [k for f in facets for k in FACETS[f]]
    sets = [[F.col(k) for k in (*FACETS[f], *more)] for f in facets]
    # The bits of the columns that a set leaves out, the first column highest.
    number = {f: int("".join("01"[k not in FACETS[f]] for k in keys) + "0" * len(more), 2) for f in facets}
    facet = F.lit(None).cast("string")
    for f, bits in number.items():
        facet = F.when(F.col("_set") == bits, f).otherwise(facet)
    grouped = rows.groupingSets(sets, *[F.col(k) for k in (*keys, *more)]).agg(F.grouping_id().alias("_set"), *states)
    return grouped.withColumn("facet", facet).drop("_set")


def states(sales: DataFrame) -> DataFrame:
    """``facet``, all keys and the partial states of a batch of cleaned sales."""
    return _grouped(sales, list(FACETS), (), *[F.expr(sql).alias(name) for name, sql in state_sql().items()]).select(
        "facet", *KEYS, *[F.col(name).cast(kind).alias(name) for name, (_, kind) in STATES.items()]
    )


def bitmaps(sales: DataFrame, numbers: DataFrame) -> DataFrame:
    """``facet``, keys, ``word`` and the bits of its customers' numbers.

    Sales meet the numbers once, before they are grouped; a customer with a
    third of all sales makes a skewed join, which Spark splits.
    """
    keys = [k for f in COUNTED for k in FACETS[f]]
    met = sales.filter(F.col("customer_id").isNotNull()).select("customer_id", *keys).join(numbers, "customer_id")
    bit = F.expr("shiftleft(1L, cast(number & 63 AS int))")
    rows = met.select(*keys, F.shiftright("number", 6).alias("word"), bit.alias("_bit"))
    return _grouped(rows, COUNTED, ("word",), F.bit_or("_bit").alias("bits")).select("facet", *keys, "word", "bits")


def numbered(customers: DataFrame, first: int) -> DataFrame:
    """``customer_id, number`` of distinct customers, numbered without gaps from ``first``.

    Each partition counts its own; only the counts per partition are put in
    order, and no row is moved for its number.
    """
    ensure_checkpoint_dir(customers.sparkSession)
    placed = customers.select("customer_id", F.monotonically_increasing_id().alias("_at")).checkpoint()
    part, within = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", (F.coalesce(before, F.lit(0)) + first).alias("_start"))
    # One row per partition.
    joined = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return joined.select("customer_id", (F.col("_start") + within).alias("number"))


class Rollup:
    """The rollup stored under ``path``; batches are added one after another.

    ``states`` and ``bitmaps`` are written anew with every batch, a few rows per
    group. Customer numbers only grow: a batch adds a folder with those it saw
    first. A failed ``add`` changes nothing for readers and can be repeated.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _read(self, folder: str, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}")

    def _numbers(self, batches: int) -> DataFrame | None:
        if not batches:
            return None
        return self.spark.read.parquet(*[f"{self.path}/customers/{n:09d}" for n in range(1, batches + 1)])

    def add(self, sales: DataFrame) -> None:
        """Merge a batch of cleaned sales whose orders no batch before has."""
        with new_version(self.spark, self.path) as version:
            before = current(self.spark, self.path)
            known = self._numbers(version.number - 1)
            seen = sales.select("customer_id").filter(F.col("customer_id").isNotNull()).distinct()
            if known is not None:
                seen = seen.join(known, "customer_id", "left_anti")
            first = 1 if known is None else known.count() + 1
            own = f"{self.path}/customers/{version.number:09d}"
            numbered(seen, first).write.mode("overwrite").parquet(own)
            numbers = self._numbers(version.number)
            new_states, new_bitmaps = states(sales), bitmaps(sales, numbers)
            if before is not None:
                new_states = merge_states(new_states.unionByName(self._read(before.folder, "states")))
                new_bitmaps = merge_bitmaps(new_bitmaps.unionByName(self._read(before.folder, "bitmaps")))
            new_states.write.partitionBy("facet").parquet(f"{version.folder}/states")
            new_bitmaps.write.partitionBy("facet").parquet(f"{version.folder}/bitmaps")

    def _stored(self, name: str, facet: str) -> DataFrame:
        version = current(self.spark, self.path)
        if version is None:
            raise FileNotFoundError(f"no rollup at {self.path}; add a batch first")
        return self._read(version.folder, name).filter(F.col("facet") == facet)

    def figures(self, facet: str, keys: Sequence[str] | None = None, **shown: str) -> DataFrame:
        """Measures per ``keys``, those of the facet or some of them.

        States and customer counts are put under each other and added up, so
        that groups whose key is missing need no join.
        """
        keys = list(FACETS[facet] if keys is None else keys)
        rows = self._stored("states", facet).select(*keys, *STATES, F.lit(None).cast("long").alias("customers"))
        if "customers" in shown.values():
            groups = self._stored("bitmaps", facet).groupBy(*keys, "word").agg(F.bit_or("bits").alias("bits"))
            nothing = [F.lit(None).cast(kind).alias(name) for name, (_, kind) in STATES.items()]
            rows = rows.union(groups.select(*keys, *nothing, F.bit_count("bits").cast("long")))
        sums = [F.sum(c).cast(kind).alias(c) for c, (_, kind) in STATES.items()]
        totals = rows.groupBy(*keys).agg(*sums, F.coalesce(F.sum("customers"), F.lit(0)).alias("customers"))
        return totals.select(*keys, *state_measures(**shown))


def merge_states(rows: DataFrame) -> DataFrame:
    """States of several batches added up."""
    return rows.groupBy("facet", *KEYS).agg(*[F.sum(c).cast(kind).alias(c) for c, (_, kind) in STATES.items()])


def merge_bitmaps(rows: DataFrame) -> DataFrame:
    """Bitmaps of several batches ORed."""
    keys = [k for f in COUNTED for k in FACETS[f]]
    return rows.groupBy("facet", *keys, "word").agg(F.bit_or("bits").alias("bits"))


# --- the KPI queries, from the rollup -----------------------------------------


def overall_kpis(rollup: Rollup) -> DataFrame:
    return rollup.figures("month", (), **kpi.OVERALL)


def revenue_trend_monthly(rollup: Rollup, year: int | None = None) -> DataFrame:
    months = rollup.figures("month", **kpi.MONTHLY)
    if year:
        months = months.filter(F.col("order_year") == year)
    return months.orderBy("order_year", "order_month")


def top_products(rollup: Rollup, limit: int = 10) -> DataFrame:
    return kpi.most_revenue(rollup.figures("product", **kpi.PRODUCTS), limit)


def requested_products(rollup: Rollup, limit: int | None = None) -> DataFrame:
    return top_products(rollup, kpi.clamp_limit(limit))


def region_segment_matrix(rollup: Rollup) -> DataFrame:
    return rollup.figures("place", **kpi.MATRIX).orderBy(F.desc("revenue"), "region", "segment")


def sales_rep_leaderboard(rollup: Rollup) -> DataFrame:
    return rollup.figures("rep", **kpi.REPS).orderBy(F.desc("total_revenue"), "sales_rep")


def discount_impact(rollup: Rollup) -> DataFrame:
    return kpi.pricing_labels(rollup.figures("pricing", **kpi.DISCOUNTS))


def low_margin_alerts(rollup: Rollup, threshold: float = 20) -> DataFrame:
    return kpi.below_margin(rollup.figures("product", **kpi.ALERTS), threshold)


def _view(rollup: Rollup, name: str, facet: str) -> DataFrame:
    view = VIEWS[name]
    return view.sorted(rollup.figures(facet, view.keys, **view.shown))


def monthly_kpi(rollup: Rollup) -> DataFrame:
    return _view(rollup, "monthly_kpi", "month")


def category_kpi(rollup: Rollup) -> DataFrame:
    return _view(rollup, "category_kpi", "product")


def rep_performance(rollup: Rollup) -> DataFrame:
    return _view(rollup, "rep_performance", "rep")
