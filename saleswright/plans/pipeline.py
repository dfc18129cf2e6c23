"""End-to-end runs: raw sales to stored table, forecast and report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import Checks, clean, validate, with_rfm
from ..session import working_dir
from ..sources import publish, read_sales, write_csv, write_sales, written_once
from .forecast import WEEKS, Settings, Trained, run_forecaster
from .marts import report_marts, write_marts
from .views import register_sales


@dataclass(frozen=True)
class Layout:
    """Folders of one deployment."""

    root: str

    @property
    def sales(self) -> str:
        return f"{self.root}/sales"

    @property
    def sales_csv(self) -> str:
        return f"{self.root}/sales_csv"

    @property
    def models(self) -> str:
        return f"{self.root}/models"

    @property
    def report(self) -> str:
        return f"{self.root}/report"


def run_etl(raw: DataFrame, root: str, keys: Sequence[str] = ("order_id",), export_csv: bool = True) -> DataFrame:
    """Check, clean, enrich and store; returns the stored table.

    The cleaned rows are written once, since the customer figures need them
    several times over and the duplicate check should not run for each. Issues
    are counted in that write, so raw is read once. All outputs are replaced, so
    a second run leaves the same tables.
    """
    out = Layout(root)
    checks = Checks() if working_dir(raw.sparkSession) else None
    with written_once(clean(raw if checks else validate(raw), keys, checks)) as cleaned:
        if checks:
            checks.report()
        write_sales(with_rfm(cleaned), out.sales)
    sales = read_sales(raw.sparkSession, out.sales)
    register_sales(sales)
    if export_csv:
        write_csv(publish(sales), out.sales_csv)
    return sales


def run_report(sales: DataFrame, root: str, predicted: DataFrame | None = None) -> list[str]:
    """Write the report tables."""
    return write_marts(report_marts(sales, predicted), Layout(root).report)


def run_all(
    raw: DataFrame,
    root: str,
    keys: Sequence[str] = ("order_id",),
    series: Sequence[str] = (),
    settings: Settings = Settings(),
    weeks: int = WEEKS,
) -> tuple[DataFrame, Trained, DataFrame]:
    """Store sales, then forecast, then report."""
    sales = run_etl(raw, root, keys)
    trained, predicted = run_forecaster(sales, Layout(root).models, series, settings, weeks)
    run_report(sales, root, predicted)
    return sales, trained, predicted
