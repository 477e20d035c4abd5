"""Run the daily batch: ``spark-submit`` this file or ``python -m fleetmart``.

    python -m fleetmart --base /lake --feed /incoming/feed --register /incoming/register.csv
"""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import SparkSession

from fleetmart.plans.layout import Layout
from fleetmart.plans.medallion import run_daily
from fleetmart.sources.feeds import read_bodies


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="fleetmart")
    parser.add_argument("--base", required=True, help="folder of all tables")
    parser.add_argument("--feed", help="folder of feed responses, one JSON body per file")
    parser.add_argument("--fields", nargs="+", help="feed fields to land (default: all found)")
    parser.add_argument("--register", nargs="+", help="register files, ';'-separated")
    parser.add_argument("--pages", help="table of catalogue pages (page_id, url, html) to choose the register from")
    parser.add_argument("--format", default="parquet", help="format of refined and served tables")
    parser.add_argument("--by-event-day", action="store_true", help="keep refined positions by event day")
    parser.add_argument("--since", help="refine only positions landed from this day on (needs --by-event-day)")
    parser.add_argument("--run-ts", type=datetime.fromisoformat, default=None, help="time of the run (default: now)")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("fleetmart").getOrCreate()
    run = run_daily(
        spark,
        Layout(args.base, fmt=args.format, by_event_day=args.by_event_day),
        args.run_ts or datetime.now(),
        bodies=read_bodies(spark, args.feed) if args.feed else None,
        fields=args.fields,
        register=args.register,
        pages=spark.read.parquet(args.pages) if args.pages else None,
        since=args.since,
    )
    for stage in run.stages:
        print(f"{stage.stage}: {stage.status} {stage.path} {stage.detail}".rstrip())
    for check in run.checks:
        print(f"{check['rule']}: {check['status']} ({check['observed']:g})")
    run.report.show(truncate=False)


if __name__ == "__main__":
    main()
