"""Command line: ``run`` the whole flow, or ``check`` a folder of extracts against the report rules."""

from __future__ import annotations

import argparse
import json
import sys
from collections import defaultdict

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from admitflow import session
from admitflow import vocabulary as V
from admitflow.plans import report
from admitflow.plans.flow import Flow
from admitflow.plans.gates import DataQualityError
from admitflow.sources.tables import Layer

_LINE_BREAKS = {"look": None, "yes": True, "no": False}


def _missing(spark: SparkSession, folder: str) -> bool:
    """Whether a source is not there; says which. Nothing is read yet."""
    try:
        for source in V.SOURCE_COLUMNS:
            spark.read.text(f"{folder.rstrip('/')}/{source}.csv")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        print(error)
        return True
    return False


def _run(args: argparse.Namespace) -> int:
    spark = session.build()
    if _missing(spark, args.source):
        return 2
    try:
        counts = Flow(spark, args.source, args.warehouse, args.output).run()
    except DataQualityError as error:
        print(error)
        return 1
    for name, rows in counts.items():
        print(f"{name}: {rows} rows")
    return 0


def _check(args: argparse.Namespace) -> int:
    spark = session.build()
    if _missing(spark, args.dir):
        return 2
    # Landed once; the rules and every list of offenders read the stored tables and the stored history.
    layer = Layer(spark, args.warehouse or session.scratch_path(spark, "check"))
    tables = report.Extracts.landed(layer, args.dir, _LINE_BREAKS[args.line_breaks])
    history = layer.write("event_history", tables.history())
    for row in report.figures(tables).collect():  # one row per source
        span = f", {row['span_days']} days from {row['first_date']} to {row['last_date']}" if row["first_date"] else ""
        print(f"{row['source']}: {row['row_count']} rows{span}")
    rows = report.report(tables, history).orderBy("check_name").collect()  # one row per rule
    failed = [row["check_name"] for row in rows if row["status"] != "PASS"]
    offenders = defaultdict(list)
    for row in report.examples(tables, failed, history).orderBy("check_name", "place").collect():  # a few per rule
        offenders[row["check_name"]].append(json.loads(row["offender"]))
    for row in rows:
        print(f"[{row['status']}] {row['check_name']}: {row['bad_count']}")
        for offender in offenders[row["check_name"]]:
            print(f"    {offender}")
    print(f"{len(rows) - len(failed)} passed, {len(failed)} failed, {len(rows)} rules")
    return 1 if failed else 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="admitflow")
    commands = parser.add_subparsers(required=True)
    run = commands.add_parser("run", help="extracts to outputs")
    run.add_argument("--source", required=True)
    run.add_argument("--warehouse", required=True)
    run.add_argument("--output", required=True)
    run.set_defaults(action=_run)
    check = commands.add_parser("check", help="report on a folder of extracts")
    check.add_argument("--dir", required=True)
    check.add_argument("--warehouse", help="folder for the landed tables; else one below the shared folder")
    check.add_argument(
        "--line-breaks", choices=_LINE_BREAKS, default="look", help="whether fields hold line breaks; 'look' reads first"
    )
    check.set_defaults(action=_check)
    args = parser.parse_args(argv)
    return args.action(args)


if __name__ == "__main__":
    sys.exit(main())
