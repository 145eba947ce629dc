"""Command line: run one of the three report jobs.

    python -m lograft levels --input s3a://bucket/data/ --output s3a://bucket/output/
    python -m lograft usage  --input s3a://bucket/data/ --output s3a://bucket/output/
    python -m lograft daily  --input s3a://bucket/trips/2021/ --output out/ --year 2021
    python -m lograft errors --input s3a://bucket/data/ --output s3a://bucket/output/errors/
    python -m lograft grep   --input s3a://bucket/data/ --output out/times/ --pattern "PythonRunner: Times"
    python -m lograft stage  --input s3a://bucket/data/ --output s3a://bucket/parsed/
    python -m lograft levels --input s3a://bucket/parsed/ --parsed --output s3a://bucket/output/

``--master`` is optional (spark-submit normally supplies it). Logs are read
recursively below ``--input`` (``*.log``); trips are every Parquet file below it.
"""

from __future__ import annotations

import argparse
import json
import sys

from lograft.functions.parse import parse_lines
from lograft.operators.levels import lines_containing, lines_matching
from lograft.plans.daily_report import run_daily_report
from lograft.plans.level_report import run_level_report
from lograft.plans.usage_report import run_usage_report
from lograft.session import build_session, checkpoint_dir, s3a_conf
from lograft.sinks import write_csv
from lograft.sources.logs import read_log_lines
from lograft.sources.tables import partitioned_parquet


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="lograft", description=__doc__.splitlines()[0])
    ap.add_argument("job", choices=["levels", "usage", "daily", "errors", "grep", "stage"])
    ap.add_argument("--parsed", action="store_true",
                    help="levels/usage: --input is a parsed table written by the stage job")
    ap.add_argument("--pattern", default=None, help="grep: regular expression a line must match")
    ap.add_argument("--identity", choices=["mention", "file"], default="mention",
                    help="usage: application of a line from its text or from its file path")
    ap.add_argument("--input", required=True)
    ap.add_argument("--output", required=True)
    ap.add_argument("--master", default=None)
    ap.add_argument("--year", type=int, default=None, help="daily: calendar year to summarise")
    ap.add_argument("--exact-p95", action="store_true", help="daily: exact nearest-rank p95")
    ap.add_argument("--recursive", action="store_true", help="daily: read every file below --input, whatever its directory")
    ap.add_argument("--glob", default="*.log", help="log file name filter")
    ap.add_argument("--shuffle-partitions", type=int, default=None)
    ap.add_argument("--checkpoint-dir", default=None, help="used only when the session names none")
    args = ap.parse_args(argv)

    conf = s3a_conf() if args.input.startswith("s3a://") or args.output.startswith("s3a://") else {}
    spark = build_session(args.master, f"lograft-{args.job}", args.shuffle_partitions, conf)
    checkpoint_dir(spark, default=args.checkpoint_dir)
    try:
        def logs(with_path: bool = False):
            if args.parsed:
                return spark.read.parquet(args.input)
            return read_log_lines(spark, args.input, args.glob, with_path=with_path)

        if args.job == "levels":
            res = run_level_report(spark, logs(), args.output)
        elif args.job == "usage":
            res = run_usage_report(spark, logs(args.identity == "file"), args.output, identity=args.identity)
        elif args.job == "stage":
            # parse once: every typed column next to the raw line and its file
            parse_lines(read_log_lines(spark, args.input, args.glob, with_path=True)).write.mode(
                "overwrite"
            ).parquet(args.output)
            res = {"output": args.output}
        elif args.job in ("errors", "grep"):
            lines = read_log_lines(spark, args.input, args.glob, with_path=True)
            if args.job == "errors":
                hits = lines_containing(lines, "ERROR")
            else:
                if not args.pattern:
                    ap.error("grep needs --pattern")
                hits = lines_matching(lines, args.pattern)
            # written by every task in parallel: this output grows with the input
            write_csv(hits.select("path", "line"), args.output)
            res = {"output": args.output}
        else:
            if args.year is None:
                ap.error("daily needs --year")
            # key=value directories stay columns, so a filter on them prunes; --recursive for other trees
            reader = spark.read.option("recursiveFileLookup", "true") if args.recursive else None
            trips = reader.parquet(args.input) if reader else partitioned_parquet(spark, args.input)
            res = run_daily_report(spark, trips, args.year, args.output, exact_p95=args.exact_p95)
        print(json.dumps(res, default=str, indent=2))
        return 0
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
