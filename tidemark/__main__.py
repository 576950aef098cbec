"""Command line of the jobs, for spark-submit: ``python -m tidemark <job> ...``."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from tidemark.operators.inspect import first_dates, sample_rows
from tidemark.plans import run_bronze, run_gold, run_incremental, run_quality, run_silver
from tidemark.sources.export import export_csv
from tidemark.sources.layout import GOLD_TABLES, Lake
from tidemark.sources.tables import read_table
from tidemark.streaming.ingest import set_aside


def show_table(spark: SparkSession, path: str, rows: int) -> None:
    if rows > 0:
        table = read_table(spark, path)
        table.printSchema()
        sample_rows(table, rows).show(rows, truncate=False)


def bronze(spark: SparkSession, args: argparse.Namespace) -> None:
    written = run_bronze(
        spark, args.raw_dir, args.bronze_dir, args.glob, args.mode,
        skip_corrupt=args.skip_corrupt, header_patterns=args.header_glob, widen=args.widen,
    )
    print(f"{written} rows to {args.bronze_dir}")
    show_table(spark, args.bronze_dir, args.show)
    first_dates(read_table(spark, args.bronze_dir)).show(truncate=False)


def silver(spark: SparkSession, args: argparse.Namespace) -> None:
    written = run_silver(
        spark, args.bronze_dir, args.silver_dir, args.skip_corrupt, args.mode, args.after
    )
    print(f"{written} rows to {args.silver_dir}")
    show_table(spark, args.silver_dir, args.show)


def gold(spark: SparkSession, args: argparse.Namespace) -> None:
    run_gold(
        spark, args.silver_dir, args.gold_dir, args.session_gap_minutes, args.skip_corrupt, args.mode
    )
    for name in GOLD_TABLES:
        show_table(spark, f"{args.gold_dir}/{name}", args.show)


def incremental(spark: SparkSession, args: argparse.Namespace) -> None:
    run_incremental(
        spark,
        args.raw_dir,
        Lake(args.lake),
        args.glob,
        session_gap_minutes=args.session_gap_minutes,
        files_per_batch=args.files_per_batch,
        skip_corrupt=args.skip_corrupt,
        widen=args.widen,
    )
    for path, columns in sorted(set_aside(spark, Lake(args.lake).bronze).items()):
        print(f"set aside {path}: columns {columns}")


def quality(spark: SparkSession, args: argparse.Namespace) -> None:
    lake = Lake(args.lake)
    run_quality(spark, lake, args.event_types)
    read_table(spark, lake.quality).orderBy("checked_at", "check_name").show(truncate=False)


def export(spark: SparkSession, args: argparse.Namespace) -> None:
    for name in GOLD_TABLES:
        export_csv(read_table(spark, f"{args.gold_dir}/{name}"), f"{args.export_dir}/{name}")


def instant(text: str) -> datetime:
    """An ISO date or time; in UTC if it names no zone."""
    given = datetime.fromisoformat(text)
    return given if given.tzinfo else given.replace(tzinfo=timezone.utc)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name, run, *folders, show=None):
        sub = jobs.add_parser(name, help=run.__doc__)
        sub.set_defaults(run=run)
        for folder in folders:
            sub.add_argument(f"--{folder}", required=True)
        if show is not None:
            sub.add_argument("--show", type=int, default=show, help="rows to show, 0 for none")
        return sub

    def glob(sub):
        sub.add_argument("--glob", default="*.csv", help="names of the raw files")

    def gap(sub):
        sub.add_argument("--session-gap-minutes", type=int, default=30)

    def rebuilds(sub):
        sub.add_argument(
            "--mode",
            choices=["append", "overwrite"],
            default="overwrite",
            help="append adds rows without looking for copies; the incremental job does",
        )

    def corrupt(sub):
        sub.add_argument("--skip-corrupt", action="store_true", help="leave out unreadable files")

    sub = job("bronze", bronze, "raw-dir", "bronze-dir", show=5)
    glob(sub)
    corrupt(sub)
    sub.add_argument("--header-glob", nargs="+", help="file names, one pattern per header")
    sub.add_argument("--widen", action="store_true", help="let an append bring new columns")
    sub.add_argument("--mode", choices=["append", "overwrite"], default="append")
    sub = job("silver", silver, "bronze-dir", "silver-dir", show=10)
    rebuilds(sub)
    corrupt(sub)
    sub.add_argument("--after", type=instant, help="take only events later than this (UTC)")
    sub = job("gold", gold, "silver-dir", "gold-dir", show=5)
    gap(sub)
    rebuilds(sub)
    corrupt(sub)
    sub = job("incremental", incremental, "raw-dir", "lake")
    corrupt(sub)
    sub.add_argument("--widen", action="store_true", help="take files with more columns than before")
    sub.add_argument("--files-per-batch", type=int, help="raw files that one step takes in")
    glob(sub)
    gap(sub)
    sub = job("quality", quality, "lake")
    sub.add_argument("--event-types", nargs="+", required=True, help="the valid event types")
    job("export", export, "gold-dir", "export-dir")
    return top


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = (
        SparkSession.builder.appName(f"tidemark-{args.job}")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    args.run(spark, args)


if __name__ == "__main__":
    main()
