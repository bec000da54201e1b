"""Command line for spark-submit or `python -m grainledger`: run, ask, list, sql."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from .plans.catalogue import Answer, list_metrics, list_questions, run_metric, run_sql
from .plans.runs import FAILED
from .plans.warehouse import build_warehouse, open_warehouse
from .session import SETTINGS


def _session() -> SparkSession:
    builder = SparkSession.builder.appName("grainledger")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _print(rows: DataFrame) -> None:
    """Every row, tab-separated, one partition at a time."""
    print("\t".join(rows.columns))
    for row in rows.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def _show(answer: Answer, to: str | None) -> None:
    print(f"-- source: {answer.source}\n{answer.sql}\n")
    if to:
        answer.rows.write.parquet(to)
    else:
        _print(answer.rows)
    if answer.run is not None:
        answer.run.show(truncate=False, vertical=True)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="grainledger")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="build the warehouse from a landing zone")
    run.add_argument("--landing", required=True)
    run.add_argument("--out", required=True)
    run.add_argument("--allow-degraded-input", action="store_true")
    run.add_argument("--all-pages", action="store_true", help="read every page before building, not only suspect files")
    ask = commands.add_parser("ask", help="answer a catalogued question, showing its SQL")
    ask.add_argument("question")
    ask.add_argument("--out", required=True)
    ask.add_argument("--param", action="append", default=[], metavar="NAME=VALUE")
    commands.add_parser("list", help="list metrics and questions")
    sql = commands.add_parser("sql", help="run a read-only statement over the warehouse")
    sql.add_argument("statement")
    sql.add_argument("--out", required=True)
    for command in (ask, sql):
        command.add_argument("--to", metavar="PATH", help="write all rows there as Parquet instead of printing them")
    args = parser.parse_args(argv)

    spark = _session()
    if args.command == "run":
        record = build_warehouse(spark, args.landing, args.out, args.allow_degraded_input, args.all_pages)
        record.frame(spark).show(truncate=False, vertical=True)
        return int(record.status == FAILED)
    if args.command == "list":
        _print(list_metrics(spark))
        _print(list_questions(spark))
        return 0
    open_warehouse(spark, args.out)
    if args.command == "ask":
        _show(run_metric(spark, args.question, **dict(p.split("=", 1) for p in args.param)), args.to)
    else:
        _show(run_sql(spark, args.statement), args.to)
    return 0


if __name__ == "__main__":
    sys.exit(main())
