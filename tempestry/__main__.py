"""Command line: ``python -m tempestry JOB ...`` or as the application of ``spark-submit``."""

from __future__ import annotations

import argparse
from datetime import date

from tempestry.plans import jobs, models
from tempestry.schemas import DATASETS
from tempestry.session import build_session
from tempestry.sources import csv_files, versions


def _reading(job: argparse.ArgumentParser) -> None:
    """Options of the jobs that read CSV files."""
    job.add_argument("--on-bad", choices=("null", "error"), default="null", help="damage text that is no amount")
    job.add_argument("--bad-rows", choices=csv_files.BAD_ROWS, default="error", help="rows that do not fit the header")
    job.add_argument("--one-line-rows", action="store_true", help="no line ends inside fields: split plain CSV files")


def _pattern(text: str) -> tuple[str, str]:
    dataset, _, pattern = text.partition("=")
    if dataset not in DATASETS or not pattern:
        raise argparse.ArgumentTypeError(f"not DATASET=PATTERN: {text!r}")
    return dataset, pattern


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tempestry", description=__doc__)
    parser.add_argument("--data-gb", type=float, help="size of the data, to choose the number of shuffle partitions")
    parser.add_argument("--output-mb", type=int, help="size of coalesced partitions and files (default: Spark's 64)")
    commands = parser.add_subparsers(dest="job", required=True)
    previous = jobs.year_to_load(date.today())

    job = commands.add_parser("clean", help="one CSV file to cleaned Parquet")
    job.add_argument("source")
    job.add_argument("target")
    job.add_argument("--dataset", choices=DATASETS, required=True)
    job.add_argument("--files", type=int, help="number of output files (default: by size)")
    job.add_argument("--date-format")
    _reading(job)

    job = commands.add_parser("backfill", help="files of a range of years into the loaded tables")
    job.add_argument("source_root")
    job.add_argument("warehouse_root")
    job.add_argument("--lake", help="keep the cleaned rows as Parquet here, one folder per year")
    job.add_argument("--first", type=int, default=previous)
    job.add_argument("--last", type=int, default=previous)
    job.add_argument("--mode", choices=("replace", "append"), default="replace")
    job.add_argument("--revision", choices=("first", "latest"), help="which of several files of a year")
    job.add_argument("--date-format", type=_pattern, action="append", default=[], metavar="DATASET=PATTERN")
    job.add_argument("--rebase-century", action="store_true", help="read two-digit years in the century of the file")
    job.add_argument("--headers-differ", action="store_true", help="read each file by its own header")
    _reading(job)

    latest = {"action": "store_true", "help": "of a key's rows keep one of the latest revision"}
    job = commands.add_parser("build", help="loaded tables to facts and marts")
    job.add_argument("warehouse_root")
    job.add_argument("model_root")
    layout = job.add_mutually_exclusive_group()
    layout.add_argument("--facts-by-month", action="store_true", help="partition the fact tables by month")
    layout.add_argument("--facts-by-date", action="store_true", help="keep the fact tables in the order of their dates")
    job.add_argument("--staged", help="keep the staged tables here, and stage only what loads have changed")
    job.add_argument("--fix-year-month", action="store_true", help="label months by the start of the event")
    job.add_argument("--latest-load-wins", **latest)

    job = commands.add_parser("vacuum", help="remove loads that none of the newest versions of the loaded tables has")
    job.add_argument("warehouse_root")
    job.add_argument("--keep", type=int, default=2, help="versions that stay readable")

    job = commands.add_parser("answers", help="print what the marts say")
    job.add_argument("model_root")
    job.add_argument("--year", type=int)
    job.add_argument("-k", type=int, default=10, help="how many of the costliest event types")

    job = commands.add_parser("check", help="print the data tests' report")
    job.add_argument("warehouse_root")
    job.add_argument("--latest-load-wins", **latest)

    job = commands.add_parser("rejects", help="print how many rows of CSV files do not fit their header")
    job.add_argument("source", nargs="+")
    job.add_argument("--one-line-rows", action="store_true")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(f"tempestry-{args.job}", data_gb=args.data_gb, output_mb=args.output_mb)
    if args.job == "clean":
        jobs.clean_file(
            spark, args.source, args.target, args.dataset, args.files, not args.one_line_rows, args.bad_rows,
            date_format=args.date_format, on_bad=args.on_bad,
        )
    elif args.job == "backfill":
        jobs.backfill(
            spark, args.source_root, args.warehouse_root, args.first, args.last, lake_root=args.lake, mode=args.mode,
            revision=args.revision, date_formats=dict(args.date_format), rebase_century=args.rebase_century,
            same_header=not args.headers_differ, multiline=not args.one_line_rows, bad_rows=args.bad_rows,
            on_bad=args.on_bad,
        )
    elif args.job == "build":
        models.build(
            spark, args.warehouse_root, args.model_root, facts_by_month=args.facts_by_month, facts_by_date=args.facts_by_date,
            fix_year_month=args.fix_year_month, latest_load_wins=args.latest_load_wins, staged_root=args.staged,
        )
    elif args.job == "vacuum":
        for name in DATASETS:
            print(name, len(versions.vacuum(spark, f"{args.warehouse_root}/{name}", args.keep)))
    elif args.job == "answers":
        for question, answer in models.answers(spark, args.model_root, args.year, args.k).items():
            print(question)
            answer.show(truncate=False)
    elif args.job == "rejects":
        csv_files.csv_rejects(spark, args.source, multiline=not args.one_line_rows).show(truncate=False)
    else:
        models.check(spark, args.warehouse_root, latest_load_wins=args.latest_load_wins).show(truncate=False)


if __name__ == "__main__":
    main()
