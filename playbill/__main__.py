"""Command line: ``python -m playbill lake|load|report`` (or through spark-submit)."""

import argparse
import datetime

from pyspark.sql import DataFrame

from playbill.plans.pipeline import build_lake, load_serving
from playbill.plans.reports import REPORTS, report
from playbill.session import build_session, clear_intermediates, size_shuffles
from playbill.sinks.folders import LAYOUTS
from playbill.sources import read_serving
from playbill.versions import table_paths

GZIP_FACTOR = 5


def _arguments():
    parser = argparse.ArgumentParser(prog="playbill")
    jobs = parser.add_subparsers(dest="job", required=True)

    lake = jobs.add_parser("lake", help="raw files to the lake")
    lake.add_argument("--raw", required=True)
    lake.add_argument("--lake", required=True)
    lake.add_argument("--gz", action="store_true")
    lake.add_argument("--ledger", action="store_true", help="store exact counts by input file")
    lake.add_argument("--as-of-year", type=int, default=datetime.date.today().year)

    load = jobs.add_parser("load", help="lake to serving table and rollup")
    load.add_argument("--lake", required=True)
    load.add_argument("--serving", required=True)
    load.add_argument("--rollup")
    load.add_argument("--layout", choices=sorted(LAYOUTS), default="years")

    show = jobs.add_parser("report", help="run a named report")
    show.add_argument("name", choices=sorted(REPORTS))
    show.add_argument("--serving", required=True)
    show.add_argument("--out", help="write Parquet here instead of printing")
    show.add_argument("--rows", type=int, help="print at most so many rows (default: all)")
    return parser.parse_args()


def show_rows(df: DataFrame, most: int | None = None) -> int:
    """Print a result as tab-separated rows, streamed from Spark; returns how many there are.

    All rows are printed unless ``most`` is given; then the total is told as well.
    """
    print("\t".join(df.columns))
    total = 0
    for row in df.toLocalIterator():
        if most is None or total < most:
            print("\t".join("" if v is None else str(v) for v in row))
        total += 1
    if most is not None and total > most:
        print(f"({most} of {total} rows)")
    return total


def main():
    args = _arguments()
    spark = build_session(f"playbill-{args.job}")
    if args.job == "lake":
        # Text shrinks to about a fifth in gzip, and such a file is one task until it is spread.
        size_shuffles(spark, args.raw, factor=GZIP_FACTOR if args.gz else 1)
        outcome = build_lake(
            spark, args.raw, args.lake, args.as_of_year, suffix=".gz" if args.gz else "",
            spread=args.gz, ledger=args.ledger,
        )
        about = "" if args.ledger else "about "
        print(f"{about}{outcome.rows_read} read, {outcome.rows_kept} kept; wrote {outcome.rows}")
        show_rows(outcome.summary)
        show_rows(outcome.types)
    elif args.job == "load":
        size_shuffles(spark, *table_paths(spark, args.lake))
        outcome = load_serving(spark, args.lake, args.serving, args.rollup, layout=args.layout)
        print(f"loaded {outcome.rows}")
        for frame in (outcome.types, outcome.partitions, outcome.recent, outcome.best_movies):
            show_rows(frame)
    else:
        size_shuffles(spark, *table_paths(spark, args.serving))
        result = report(args.name, read_serving(spark, args.serving))
        if args.out:
            result.write.mode("overwrite").parquet(args.out)
        else:
            show_rows(result, args.rows)
    clear_intermediates(spark)
    spark.stop()


if __name__ == "__main__":
    main()
