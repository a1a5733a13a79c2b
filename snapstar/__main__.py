"""Run a job from the command line: ``python -m snapstar <job> ...``.

Days default to today. Paths may be anything Spark can write to.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from snapstar.functions.columns import run_date
from snapstar.plans.daily import run_checks, run_day, run_marts, run_publish
from snapstar.plans.landing import land_files
from snapstar.plans.parse import parse_raw
from snapstar.plans.silver import build_silver
from snapstar.plans.universe import update_universe
from snapstar.session import get_spark


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="snapstar", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, text: str, *needed: str) -> argparse.ArgumentParser:
        command = jobs.add_parser(name, help=text)
        for option in needed:
            command.add_argument(f"--{option}", required=True)
        command.add_argument("--date", help="the day to run, YYYY-MM-DD", default=run_date())
        return command

    day = job("day", "land, parse, flatten, publish and model one day", "files", "root", "database")
    parse = job("parse", "parse one day's files", "files", "parsed")
    silver = job("silver", "flatten one parsed day into the silver tables", "parsed", "silver")
    land = job("land", "land one day's files in the raw table", "files", "raw")
    land.add_argument("--replace", action="store_true", help="replace documents that are there")
    universe = job("universe", "add discovered ids to the tracked ones", "pages", "state")
    universe.add_argument("--first", help="first release day of a backfill")
    universe.add_argument("--last", help="last release day of a backfill")
    universe.add_argument("--raw", help="the raw table, to count what was landed")
    job("checks", "run the declared checks", "root", "database")
    published = job("publish", "publish a day of the silver tables", "root", "database")
    marts = job("marts", "model the published tables", "root", "database")
    marts.add_argument("--select", help="models to build: names, with + before or after them for what they read or what reads them")
    day.add_argument("--resume", action="store_true", help="go on from the steps that a failed run has finished")
    day.add_argument("--attempts", type=int, default=1, help="how often a step is tried")
    for command in (day, published):
        command.add_argument("--link", action="store_true", help="publish the silver folders themselves, without a copy")
    for command in (day, marts):
        command.add_argument("--full-refresh", action="store_true", help="make the fact anew from all days")
    for command in (day, parse, silver):
        command.add_argument("--mode", choices=["append", "replace_day"], default="replace_day")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> DataFrame | None:
    """Run the job; some return a report."""
    if args.job == "day":
        options = {name: getattr(args, name) for name in ("mode", "full_refresh", "link", "resume", "attempts")}
        return run_day(spark, args.files, args.root, args.database, args.date, **options)
    if args.job == "parse":
        parse_raw(spark, args.files, args.parsed, args.date, args.mode)
    elif args.job == "silver":
        build_silver(spark, args.parsed, args.silver, args.date, args.mode)
    elif args.job == "land":
        landed = land_files(spark, args.files, args.raw, args.date, replace=args.replace)
        return spark.createDataFrame([(args.date, landed)], "snapshot_date string, landed bigint")
    elif args.job == "publish":
        return run_publish(spark, args.root, args.database, args.date, link=args.link)
    elif args.job == "marts":
        run_marts(spark, args.root, args.database, args.date, full_refresh=args.full_refresh, choice=args.select)
    elif args.job == "universe":
        window = (args.first, args.last) if args.first and args.last else None
        return update_universe(spark, args.pages, args.state, args.date, window=window, landed_path=args.raw)
    else:
        return run_checks(spark, args.database, f"{args.root}/marts")
    return None


def main() -> None:
    args = arguments()
    spark = get_spark(f"snapstar-{args.job}")
    report = run(spark, args)
    if report is not None:
        # A report has one row per table or check.
        report.show(200, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
