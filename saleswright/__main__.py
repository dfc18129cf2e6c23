"""Sales from raw CSV to stored table, forecast and report; all of it or one stage."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence

from pyspark.sql import SparkSession

from .plans.forecast import WEEKS, load_forecast, run_forecaster
from .plans.pipeline import Layout, run_all, run_etl, run_report
from .session import configure
from .sources import read_sales, read_sales_csv
from .sources.raw import DATES


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="saleswright", description=__doc__)
    stages = parser.add_subparsers(dest="stage", required=True)

    def stage(name: str, text: str) -> argparse.ArgumentParser:
        own = stages.add_parser(name, help=text, description=text)
        if name in ("all", "etl"):
            own.add_argument("raw", help="CSV file, folder or pattern with the raw sales")
            own.add_argument("--dates", default=DATES, help="form of the dates in the CSV")
        own.add_argument("root", help="folder of all outputs; those of the stage are replaced")
        if name in ("all", "forecast"):
            own.add_argument("--series", nargs="*", default=[], help="columns to forecast by, such as region")
            own.add_argument("--weeks", type=int, default=WEEKS, help="weeks to forecast")
        return own

    stage("all", "every stage in turn")
    stage("etl", "check, clean and store raw sales")
    stage("forecast", "train on the stored table and forecast")
    stage("report", "write the report tables of the stored table, with the forecast if there is one")
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = configure(SparkSession.builder.appName("saleswright").getOrCreate())
    out = Layout(args.root)
    if args.stage in ("all", "etl"):
        raw = read_sales_csv(spark, args.raw, date_format=args.dates)
    if args.stage == "all":
        sales, trained, _ = run_all(raw, args.root, series=args.series, weeks=args.weeks)
        logging.info("%d sales rows, best model %s", sales.count(), trained.best)
    elif args.stage == "etl":
        logging.info("%d sales rows", run_etl(raw, args.root).count())
    elif args.stage == "forecast":
        trained, _ = run_forecaster(read_sales(spark, out.sales), out.models, args.series, weeks=args.weeks)
        logging.info("best model %s", trained.best)
    else:
        try:
            predicted = load_forecast(spark, f"{out.models}/forecast")
        except FileNotFoundError:
            predicted = None
        logging.info("wrote %s", ", ".join(run_report(read_sales(spark, out.sales), args.root, predicted)))


if __name__ == "__main__":
    main()
