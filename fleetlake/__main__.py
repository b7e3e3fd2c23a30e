"""Command line of the jobs; see ``fleetlake.jobs``."""

from __future__ import annotations

import argparse
from datetime import date, datetime

from pyspark.sql import SparkSession

from fleetlake import jobs


def main() -> None:
    parser = argparse.ArgumentParser(prog="fleetlake", description=jobs.__doc__.splitlines()[0])
    parser.add_argument("job", choices=["load-raw", "clean", "load-silver", "build-gold", "report"])
    parser.add_argument("--source", help="directory of the CSV files")
    parser.add_argument("--csv", help="where clean also writes its tables as CSV")
    parser.add_argument("--lake", required=True, help="directory of the layers")
    parser.add_argument(
        "--multi-line", action="store_true", help="quoted text may hold line breaks"
    )
    parser.add_argument(
        "--stable-keys", action="store_true", help="build-gold keeps the keys of the version before"
    )
    parser.add_argument(
        "--changes",
        action="store_true",
        help="build-gold keeps keys, and writes only the months of the fact that changed",
    )
    parser.add_argument(
        "--on-missing",
        choices=["error", "empty"],
        default="error",
        help="what an absent CSV file is to load-raw and load-silver",
    )
    parser.add_argument("--as-of", type=date.fromisoformat, help="the day that clean counts ages to")
    parser.add_argument("--run-ts", type=datetime.fromisoformat, help="the time that clean records")
    args = parser.parse_args()
    if args.job in ("load-raw", "clean") and not args.source:
        parser.error(f"{args.job} needs --source")

    spark = SparkSession.builder.appName(f"fleetlake {args.job}").getOrCreate()
    multi = {"multi_line": args.multi_line}
    rows = {
        "load-raw": lambda: jobs.load_raw(
            spark, args.source, args.lake, on_missing=args.on_missing, **multi
        ),
        "clean": lambda: jobs.clean_all(
            spark,
            args.source,
            args.lake,
            csv_to=args.csv,
            as_of=args.as_of,
            run_ts=args.run_ts,
            **multi,
        ),
        "load-silver": lambda: jobs.load_silver(
            spark, args.lake, processed_csv=args.source, on_missing=args.on_missing, **multi
        ),
        "build-gold": lambda: jobs.build_gold(
            spark, args.lake, stable_keys=args.stable_keys, only_changes=args.changes
        ),
        "report": lambda: jobs.store_reports(spark, args.lake),
    }[args.job]()
    for table, count in rows.items():
        print(f"{table:20} {count}")
    print(f"{'total':20} {sum(rows.values())}")
    if args.job == "load-silver":
        jobs.silver_profile(spark, args.lake).show()


if __name__ == "__main__":
    main()
