"""Build the star schema from the four raw inputs (``python -m starmart ...`` or spark-submit).

    python -m starmart --arrivals s3a://bucket/arrivals/ --temperatures .../temps.csv \\
        --demographics .../demographics.csv --labels .../labels.SAS --out s3a://bucket/tables/

The session comes from ``SparkSession.builder.getOrCreate()``, i.e. from the cluster's job
configuration (``spark-submit --conf ...``); ``--local N`` starts a local session instead.
The eight tables are staged and checked (rows, keys, types, completeness) before they replace the
old ones; a failed check exits non-zero and changes nothing.  ``--dynamic`` replaces only the months present in this run.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .plans.pipeline import HOME_COUNTRY, Inputs, build_all
from .session import local_session


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="starmart", description=__doc__.splitlines()[0])
    ap.add_argument("--arrivals", required=True)
    ap.add_argument("--arrivals-format", default="parquet", choices=["parquet", "csv"])
    ap.add_argument("--temperatures", required=True)
    ap.add_argument("--demographics", required=True)
    ap.add_argument("--labels", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--home", default=HOME_COUNTRY)
    ap.add_argument("--place-mode", default="reference", choices=["reference", "strict"])
    ap.add_argument("--dynamic", action="store_true", help="replace only the months in this run")
    ap.add_argument("--local", type=int, default=0, help="run on local[N] instead of the cluster")
    args = ap.parse_args(argv)

    spark = local_session(args.local) if args.local else SparkSession.builder.getOrCreate()
    inputs = Inputs(args.arrivals, args.temperatures, args.demographics, args.labels,
                    args.arrivals_format)
    report: list = []
    try:
        build_all(spark, inputs, args.out, home=args.home, place_mode=args.place_mode,
                  dynamic=args.dynamic, report=report)
    except ValueError as e:
        print(e, file=sys.stderr)
        return 1
    for row in report:                    # one small row per table
        print(f"{row['table']}: {row['rows']} rows")
    return 0


if __name__ == "__main__":
    sys.exit(main())
