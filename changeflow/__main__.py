"""Entry point of ``python -m changeflow`` and ``spark-submit``: one subcommand per job, results as JSON lines on stdout."""

import argparse
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from changeflow.operators import audits
from changeflow.operators.reports import REPORTS, peek
from changeflow.operators.rollup import GRAIN
from changeflow.plans import jobs
from changeflow.session import configure
from changeflow.sources.tables import Warehouse
from changeflow.streaming import ingest


def show(df: DataFrame) -> None:
    """Print a small result: reports, counters per window, check results."""
    for line in df.toJSON().toLocalIterator():
        print(line, flush=True)


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="changeflow")
    parser.add_argument("--warehouse", required=True, help="folder of the tables")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("run", "backfill", "stream"):
        command = commands.add_parser(name)
        command.add_argument("--landing", required=True, help="folder of landed pages")
        command.add_argument("--max-pages", type=int, default=jobs.MAX_PAGES)
        if name == "run":
            command.add_argument("--date", type=date.fromisoformat, action="append", help="window date, repeatable")
        elif name == "backfill":
            command.add_argument("--from", dest="first", type=date.fromisoformat, required=True)
            command.add_argument("--to", dest="last", type=date.fromisoformat, required=True)
            command.add_argument("--any-age", action="store_true", help="accept windows the source no longer keeps")
            command.add_argument("--resume", action="store_true", help="only steps that are not done for what has landed")
            command.add_argument("--pass-days", type=int, help="with --resume: dates to a pass, all if left out")
        else:
            command.add_argument("--checkpoint", required=True)
    commands.add_parser("refresh")
    commands.add_parser("check")
    commands.add_parser("coverage")
    commands.add_parser("idempotency")
    commands.add_parser("inject-fault")
    commands.add_parser("report").add_argument("name", choices=sorted(REPORTS))
    commands.add_parser("peek").add_argument("--rows", type=int, default=20)
    return parser.parse_args()


def main() -> None:
    args = arguments()
    spark = configure(SparkSession.builder.appName(f"changeflow {args.command}").getOrCreate())
    warehouse = Warehouse(spark, args.warehouse)
    match args.command:
        case "run":
            show(jobs.run(spark, args.landing, args.warehouse, args.date, args.max_pages))
        case "backfill":
            retention = None if args.any_age else jobs.RETENTION_DAYS
            place = (spark, args.landing, args.warehouse, args.first, args.last)
            options = {"retention_days": retention, "max_pages": args.max_pages}
            if args.resume:
                show(jobs.resume_backfill(*place, pass_days=args.pass_days, **options))
            else:
                show(jobs.backfill(*place, **options))
        case "stream":
            ingest.run_available(spark, args.landing, args.warehouse, args.checkpoint, args.max_pages)
        case "refresh":
            jobs.refresh(warehouse)
        case "check":
            report = jobs.check(warehouse, strict=False)
            show(report)
            jobs.require_quality(report)
        case "coverage":
            show(audits.backfill_coverage(warehouse.mart()))
        case "idempotency":
            show(audits.window_loads(warehouse.raw()))
            show(audits.day_totals(warehouse.mart()))
        case "inject-fault":
            jobs.inject_fault(warehouse)
        case "report":
            show(REPORTS[args.name](warehouse.mart()))
        case "peek":
            show(peek(warehouse.mart(), args.rows, GRAIN))


if __name__ == "__main__":
    main()
