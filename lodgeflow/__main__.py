"""Command line: the run order and the stand-alone reports.

    python -m lodgeflow run --csv PATH [--weather PATH] [--currency PATH] [--events PATH] --root PATH [--database NAME]
    python -m lodgeflow profile --table PATH_OR_NAME
    python -m lodgeflow quality --table PATH_OR_NAME [--extended]
    python -m lodgeflow gold --table PATH_OR_NAME

Reports print one JSON object per row; nothing but report rows reaches the
driver.  The session comes from ``spark-submit`` / the environment; pass
``--cluster`` for the large-cluster settings of ``lodgeflow.session``.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _print_rows(df) -> None:
    for row in df.toLocalIterator():
        print(json.dumps(row.asDict(), default=str))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="lodgeflow")
    p.add_argument("--cluster", action="store_true", help="large-cluster session settings")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="ingest -> silver -> stream -> validate -> gold")
    r.add_argument("--csv", required=True)
    r.add_argument("--weather")
    r.add_argument("--currency")
    r.add_argument("--events")
    r.add_argument("--root", required=True)
    r.add_argument("--database", help="keep tables and gold views in this database of the catalog")
    for name in ("profile", "quality", "gold"):
        c = sub.add_parser(name)
        c.add_argument("--table", required=True)
        if name == "quality":
            c.add_argument("--extended", action="store_true", help="six checks instead of four")
    args = p.parse_args(argv)

    if spark is None:
        from lodgeflow.session import get_session
        spark = get_session(cluster=args.cluster)
    from lodgeflow.sources.files import read_table

    if args.cmd == "run":
        from lodgeflow.plans.run_order import run_all_stages
        _print_rows(run_all_stages(spark, args.csv, args.weather, args.currency, args.events, args.root,
                                   args.database))
    elif args.cmd == "profile":
        from lodgeflow.operators.profile import null_profile
        _print_rows(null_profile(read_table(spark, args.table)))
    elif args.cmd == "quality":
        from lodgeflow.operators import quality
        df = read_table(spark, args.table)
        suite = quality.extended_suite(df) if args.extended else quality.blocking_suite(df)
        _print_rows(quality.quality_report(df, suite))
    elif args.cmd == "gold":
        from lodgeflow.plans.gold import refresh_gold
        _print_rows(refresh_gold(spark, args.table))
    return 0


if __name__ == "__main__":
    sys.exit(main())
