"""Run the three questions over published tables: ``spark-submit main.py ROOT [RUNS]``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from cityobs.plans.weather import QUERIES, VARIANTS, run_matrix
from cityobs.sources import FORMATS, Layout


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("root", help="folder above data/, results/ and stats/")
    parser.add_argument("runs", nargs="?", type=int, default=1, help="runs per cell, two are warm-up")
    parser.add_argument("--formats", nargs="+", choices=FORMATS, default=["csv", "parquet"])
    parser.add_argument("--variants", nargs="+", choices=VARIANTS, default=list(VARIANTS))
    parser.add_argument("--queries", nargs="+", choices=list(QUERIES), default=list(QUERIES))
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("cityobs").getOrCreate()
    run_matrix(
        spark, Layout(args.root), args.runs, args.formats, args.variants, args.queries
    ).show(truncate=False)


if __name__ == "__main__":
    main()
