"""Command line.

    python -m marquee stage   --pages P --staging S [--services FILE] [--range 1991-2000 ...] [--range 2024-]
    python -m marquee jobs    --staging S --root R [--format parquet] [--table NAME ...]
    python -m marquee publish --root R --db D [--countries CSV]
    python -m marquee all     (the options of the three together)

``--services`` names a JSON Lines selection of any length; ``--default-services`` takes the
built-in one. Without either no title and no offer is filtered: the request has done that,
and a service spelt differently in the answers would lose its titles.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from marquee.constants import YEAR_BOUNDARIES
from marquee.functions.years import OPEN_HIGH, OPEN_LOW, YearRange
from marquee.operators.filters import TitleFilter, selected_names
from marquee.plans.publish import publish, run_all, run_jobs
from marquee.plans.stage import stage_pages
from marquee.schemas import TITLE_TABLES
from marquee.session import build_session
from marquee.sources import read_service_selection


def _year_range(text: str) -> YearRange:
    """``1991-2000``; ``2024-`` and ``-1899`` are open."""
    low, _, high = text.partition("-")
    return int(low or OPEN_LOW), int(high or OPEN_HIGH)


def parser() -> argparse.ArgumentParser:
    stage = argparse.ArgumentParser(add_help=False)
    stage.add_argument("--pages", required=True)
    stage.add_argument("--json-lines", action="store_true", help="one page per line")
    stage.add_argument("--range", type=_year_range, action="append", metavar="MIN-MAX")
    stage.add_argument("--boundary", type=int, action="append", metavar="YEAR", help="last year of a staging range, in rising order; by default the fixed list")
    stage.add_argument("--allow-incomplete", action="store_true")
    stage.add_argument("--refuse-broken", action="store_true", help="go on without documents that can not be read")
    stage.add_argument("--refresh", action="store_true", help="parse unchanged files again")
    stage.add_argument("--errors", help="table for the errors of failed pages")
    which = stage.add_mutually_exclusive_group()
    which.add_argument("--services", help="service selection, JSON Lines")
    which.add_argument("--default-services", action="store_true")
    which.add_argument("--all-services", action="store_true", help="as without the option")

    staging = argparse.ArgumentParser(add_help=False)
    staging.add_argument("--staging", required=True)
    jobs = argparse.ArgumentParser(add_help=False)
    jobs.add_argument("--format", default="parquet", choices=("parquet", "json", "legacy", "table"))
    jobs.add_argument("--table", action="append", default=[],
                      choices=[contract.name for contract in TITLE_TABLES])
    root = argparse.ArgumentParser(add_help=False)
    root.add_argument("--root", required=True)
    shown = argparse.ArgumentParser(add_help=False)
    shown.add_argument("--db", required=True)
    shown.add_argument("--db-location")
    shown.add_argument("--countries", help="CSV with header: name, alpha2_code, alpha3_code and, if wanted, flag")

    top = argparse.ArgumentParser(prog="marquee")
    steps = top.add_subparsers(dest="step", required=True)
    steps.add_parser("stage", parents=[stage, staging])
    steps.add_parser("jobs", parents=[staging, jobs, root])
    steps.add_parser("publish", parents=[root, shown])
    steps.add_parser("all", parents=[stage, staging, root, shown])
    return top


def _stage_options(spark: SparkSession, args: argparse.Namespace) -> dict:
    names = selected_names() if args.default_services else ()
    services = read_service_selection(spark, args.services) if args.services else None
    return {
        "ranges": args.range,
        "wanted": TitleFilter(services=names),
        "offer_services": names if services is None else services,
        "services": services,
        "multi_line": not args.json_lines,
        "complete": not args.allow_incomplete,
        "errors_path": args.errors,
        "boundaries": tuple(args.boundary or YEAR_BOUNDARIES),
        "broken": "refuse" if args.refuse_broken else "fail",
        "refresh": args.refresh,
    }


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = spark or build_session()
    if args.step == "stage":
        stage_pages(spark, args.pages, args.staging, **_stage_options(spark, args))
        return
    if args.step == "jobs":
        run_jobs(spark, args.staging, args.root, args.format, args.table)
        return
    countries = args.countries and spark.read.csv(args.countries, header=True, inferSchema=False, mode="FAILFAST")
    if args.step == "publish":
        publish(spark, args.db, args.root, countries or None, args.db_location)
        return
    places = (args.pages, args.staging, args.root, args.db)
    run_all(spark, *places, countries or None, args.db_location, **_stage_options(spark, args))


if __name__ == "__main__":
    main()
