"""Command line: ``python -m tallymart <job> --root <warehouse> [options]``."""

import argparse

from .config import PRODUCT_CATEGORIES
from .plans.build import RetailWarehouse
from .plans.ingest import run_ingest
from .session import build_session
from .sources.warehouse import Warehouse

# Row counts and days that the quality checks ask for unless told otherwise.
LIMITS = {"min_orders": 9000, "min_customers": 1900, "min_days": 400}


def parse(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tallymart", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name, text):
        sub = jobs.add_parser(name, help=text)
        sub.add_argument("--root", required=True, help="warehouse folder")
        return sub

    job("ingest", "load raw files").add_argument("--data", required=True, help="raw file folder")
    job("marts", "build the revenue marts")
    models = job("models", "build segments, churn predictions and forecast")
    models.add_argument("--snapshot", help="date to measure recency from (default: last order + 1)")
    models.add_argument("--train-before", help="train the forecast on earlier days only")
    quality = job("quality", "run the data quality checks")
    quality.add_argument("--report", help="folder for the JSON report")
    for name, least in LIMITS.items():
        text = f"least that passes, exclusive (default: {least})"
        quality.add_argument(f"--{name.replace('_', '-')}", type=int, default=least, help=text)
    quality.add_argument("--category", action="append", help="an accepted category; may be repeated")
    job("export", "write the dashboard's CSV files").add_argument("--out", required=True)
    job("report", "show the figures of the weekly report")
    return parser.parse_args(argv)


def show(frames) -> None:
    for name, frame in frames.items():
        print(name)
        frame.show(truncate=False)


def main(argv=None) -> None:
    args = parse(argv)
    spark = build_session("tallymart")
    retail = RetailWarehouse(Warehouse(spark, args.root))
    if args.job == "ingest":
        run_ingest(spark, args.data, args.root).show()
    elif args.job == "marts":
        retail.build_marts()
    elif args.job == "models":
        retail.build_models(args.train_before, args.snapshot)
        show(retail.evaluation())
    elif args.job == "quality":
        accepted = tuple(args.category or PRODUCT_CATEGORIES)
        limits = {name: getattr(args, name) for name in LIMITS} | {"categories": len(accepted)}
        checks = retail.check_quality(args.report, **limits)
        show({"checks": checks.orderBy("position"), "columns": retail.check_columns(accepted)})
    elif args.job == "export":
        retail.export(args.out)
    else:
        show(retail.weekly_report())


if __name__ == "__main__":
    main()
