"""Command line: ``python -m martloom run --raw DIR --storage DIR`` or ``... report NAME``."""

from __future__ import annotations

import argparse
import inspect

from martloom.plans.catalog_layers import publish
from martloom.plans.pipeline import BATCH_MODE, INCREMENTAL_MODE, run_job
from martloom.plans.reports import Reports
from martloom.session import get_session

_NO_REPORTS = {
    "table", "published_run", "register_views", "compact", "prune", "is_upserted", "mart_folder",
    "cleaned_folder", "folded",
}
_REPORTS = sorted(
    n
    for n, f in inspect.getmembers(Reports, inspect.isfunction)
    if not n.startswith("_") and n not in _NO_REPORTS
)


def main() -> None:
    parser = argparse.ArgumentParser(prog="martloom")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="ingest, clean and aggregate")
    run.add_argument("--raw", required=True)
    run.add_argument("--storage", required=True)
    run.add_argument("--mode", choices=(BATCH_MODE, INCREMENTAL_MODE), default=BATCH_MODE)
    run.add_argument("--keep", choices=("latest", "earliest"), default="latest")
    run.add_argument("--reject-malformed", action="store_true", help="reject broken CSV rows")
    run.add_argument("--catalog", metavar="SCHEMA", help="also publish the layers as views")
    compact = commands.add_parser("compact", help="fold the batches of upserted tables")
    compact.add_argument("--storage", required=True)
    prune = commands.add_parser("prune", help="delete the folders of runs before the newest successful one")
    prune.add_argument("--storage", required=True)
    report = commands.add_parser("report", help="show a report of the newest run")
    report.add_argument("name", choices=_REPORTS)
    report.add_argument("--storage", required=True)
    report.add_argument("--table", help="for the reports on rejects")
    report.add_argument("--limit", type=int)
    args = parser.parse_args()
    if args.command == "report":
        wanted = inspect.signature(getattr(Reports, args.name)).parameters.get("table")
        if wanted is not None and wanted.default is inspect.Parameter.empty and not args.table:
            parser.error(f"report {args.name} needs --table")

    spark = get_session()
    if args.command == "run":
        done = run_job(
            spark, args.raw, args.storage,
            mode=args.mode, keep=args.keep, reject_malformed=args.reject_malformed,
        )
        if args.catalog:
            publish(spark, args.storage, args.catalog)
        print(done["execution_id"], done["status"])
        return
    if args.command == "compact":
        Reports(spark, args.storage).compact()
        return
    if args.command == "prune":
        print(*Reports(spark, args.storage).prune(), sep="\n")
        return
    given = {"table": args.table, "n": args.limit}
    method = getattr(Reports(spark, args.storage), args.name)
    takes = inspect.signature(method).parameters
    method(**{k: v for k, v in given.items() if k in takes and v is not None}).show(
        args.limit or 50, truncate=False
    )


if __name__ == "__main__":
    main()
