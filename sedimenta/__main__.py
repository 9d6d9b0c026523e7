"""Run a job on trip records: ``python -m sedimenta bronze|silver|marts|quality|all ...``."""

from __future__ import annotations

import argparse
import sys
from dataclasses import replace

from pyspark.sql import SparkSession

from sedimenta import presets
from sedimenta.plans import jobs
from sedimenta.plans.specs import BronzePolicy, RunConfig, RunReport, SilverSpec
from sedimenta.session import ship


def _parse(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="sedimenta")
    commands = parser.add_subparsers(dest="job", required=True)
    for name in ("bronze", "silver"):
        command = commands.add_parser(name)
        command.add_argument("src")
        command.add_argument("dst")
        _add_options(command)
    marts = commands.add_parser("marts")
    marts.add_argument("table")
    marts.add_argument("path")
    quality = commands.add_parser("quality")
    quality.add_argument("path")
    quality.add_argument("--rows", type=int, default=10_000)
    everything = commands.add_parser("all")
    for name in ("raw", "bronze", "silver", "table"):
        everything.add_argument(name)
    _add_options(everything)
    return parser.parse_args(argv)


def _add_options(command: argparse.ArgumentParser) -> None:
    command.add_argument("--publish", action="store_true", help="write aside, then make all partitions current at once")
    command.add_argument("--preview", type=int, default=0, help="rows of the result to show")
    command.add_argument("--manifest", help="folder of the catalog of files that is kept from run to run")


def _settings(args: argparse.Namespace) -> tuple[BronzePolicy, SilverSpec]:
    chosen = {"mode": "publish"} if args.publish else {}
    bronze = replace(presets.TRIP_BRONZE, preview=args.preview, manifest_path=args.manifest, **chosen)
    return bronze, replace(presets.TRIP_SILVER, preview=args.preview, **chosen)


def run(spark: SparkSession, argv: list[str]) -> list[RunReport]:
    args = _parse(argv)
    if args.job == "bronze":
        return [jobs.run_bronze(spark, args.src, args.dst, _settings(args)[0])]
    if args.job == "silver":
        return [jobs.run_silver(spark, args.src, args.dst, _settings(args)[1])]
    if args.job == "marts":
        return [jobs.run_marts(spark, args.table, args.path, presets.TRIP_MARTS)]
    if args.job == "quality":
        return [jobs.run_quality(spark, args.path, presets.trip_suite(), args.rows)]
    config = RunConfig(
        args.raw, args.bronze, args.silver, args.table, *_settings(args), presets.TRIP_MARTS,
    )
    return jobs.run_all(spark, config)


def main() -> int:
    spark = SparkSession.builder.appName("sedimenta").getOrCreate()
    ship(spark)
    reports = run(spark, sys.argv[1:])
    for report in reports:
        print(report.job, report.status, report.rows if report.rows is not None else "", report.error or "")
        for frame in report.frames.values():
            frame.show(truncate=False)
    return max(r.exit_code for r in reports)


if __name__ == "__main__":
    sys.exit(main())
