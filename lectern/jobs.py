"""Command line of the periodic jobs.

    python -m lectern.jobs <base> land-bulk <folder>
    python -m lectern.jobs <base> land-batch <root>
    python -m lectern.jobs <base> watch <folder>
    python -m lectern.jobs <base> bulk
    python -m lectern.jobs <base> incremental [<load> ...]
    python -m lectern.jobs <base> marts [current|v1]

Loads read the lake's own source tables, or a database when ``--jdbc-url`` is given
(``--jdbc-option user=...`` for its connection options).
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from lectern.plans import pipelines
from lectern.session import build_session
from lectern.sources.jdbc import JdbcSource


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lectern.jobs")
    top.add_argument("base", help="folder of the lake, shared by all executors")
    top.add_argument("--parallel", type=int, default=8, help="tables handled side by side")
    top.add_argument("--parts", type=int, default=pipelines.MOST_PARTS,
                     help="key ranges that a table is cut into")
    top.add_argument("--no-checks", action="store_true",
                     help="land files that break references or text limits")
    top.add_argument("--multi-line", action="store_true",
                     help="allow line breaks inside quoted texts")
    top.add_argument("--database", help="catalog database in which marts are declared")
    top.add_argument("--catalog", help="warehouse tables that take row-level writes")
    top.add_argument("--jdbc-url")
    top.add_argument("--jdbc-option", action="append", default=[], metavar="NAME=VALUE")
    top.add_argument("--jdbc-partitions", type=int, default=64)
    jobs = top.add_subparsers(dest="job", required=True)
    jobs.add_parser("land-bulk").add_argument("folder")
    jobs.add_parser("land-batch").add_argument("root")
    jobs.add_parser("watch").add_argument("folder")
    jobs.add_parser("bulk")
    jobs.add_parser("marts").add_argument(
        "suite", nargs="?", default="current", choices=list(pipelines.SUITES)
    )
    jobs.add_parser("incremental").add_argument(
        "loads", nargs="*", default=[], help=f"of {', '.join(pipelines.INCREMENTAL_LOADS)}"
    )
    return top


def source_of(lake: pipelines.Lake, args: argparse.Namespace) -> Mapping[str, DataFrame]:
    if not args.jdbc_url:
        return lake.source_tables()
    connection = dict(option.split("=", 1) for option in args.jdbc_option)
    return JdbcSource(lake.spark, args.jdbc_url, args.jdbc_partitions, **connection)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or build_session(f"lectern {args.job}")
    lake = pipelines.Lake(spark, args.base, args.parallel, args.database, args.catalog,
                          args.parts)
    now = datetime.now(timezone.utc)
    if args.job == "land-bulk":
        pipelines.land_bulk(lake, args.folder, now, enforce=not args.no_checks,
                            multi_line=args.multi_line)
    elif args.job == "land-batch":
        pipelines.land_batch(lake, args.root, now, enforce=not args.no_checks,
                            multi_line=args.multi_line)
    elif args.job == "watch":
        from lectern.streaming.land import start_landing

        start_landing(
            lake, args.folder, f"{lake.base}/checkpoint/watch", enforce=not args.no_checks,
            multi_line=args.multi_line, processingTime="1 minute",
        ).awaitTermination()
    elif args.job == "bulk":
        pipelines.run_bulk(lake, source_of(lake, args), now)
    elif args.job == "marts":
        pipelines.rebuild_marts(lake, suite=args.suite)
    else:
        pipelines.run_cycle(lake, source_of(lake, args), now, loads=args.loads)


if __name__ == "__main__":
    main()
