"""Command line: stage once, build the reporting marts, export CSV.

    python -m stepwise run --events PATH [--window 20201101 20210131] --export DIR [--stage DIR]
    python -m stepwise run --fixture /root/testdata/sf0.1 --export DIR

``--events`` reads a raw events table partitioned by ``event_date``;
``--fixture`` maps the flat test ``events`` table instead. On a cluster,
submit with spark-submit; ``--stage`` defaults to a fresh folder under the
session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json
import sys

from stepwise.plans.pipeline import run_pipeline
from stepwise.session import build_session
from stepwise.sources.fixture import load_raw
from stepwise.sources.ga4 import DEFAULT_WINDOW, read_raw_events


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="stepwise")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="stage, build marts, export CSV")
    src = run.add_mutually_exclusive_group(required=True)
    src.add_argument("--events", help="raw events table partitioned by event_date")
    src.add_argument("--fixture", help="directory holding the flat events.parquet test table")
    run.add_argument("--window", nargs=2, metavar=("FROM", "TO"), help="inclusive yyyyMMdd range")
    run.add_argument("--export", required=True, help="output directory for the CSV files")
    run.add_argument("--stage", help="folder for the staged tables (default: under spark.checkpoint.dir)")
    run.add_argument("--master", help="Spark master for local runs (default: from spark-submit)")
    args = ap.parse_args(argv)

    spark = build_session(args.master)
    if args.events:
        window = tuple(args.window) if args.window else DEFAULT_WINDOW
        raw = read_raw_events(spark, args.events, window)
    else:
        window = tuple(args.window) if args.window else None
        raw = load_raw(spark, args.fixture)
    paths = run_pipeline(raw, window, args.export, args.stage)
    print(json.dumps(paths))
    return 0


if __name__ == "__main__":
    sys.exit(main())
