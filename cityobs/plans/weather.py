"""The three questions asked of published tables, and the timed matrix of all of them."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from cityobs.operators.reshape import to_long
from cityobs.operators.runs import RUN_SCHEMA, WARMUP_RUNS, summarize_runs
from cityobs.plans.ingest import CITIES, DESCRIPTION
from cityobs.plans.stats import monthly_stats
from cityobs.plans.sunny import sunny_periods
from cityobs.plans.swing import seasonal_swing
from cityobs.sources.layout import Layout
from cityobs.sources.tables import FORMATS, read_table, write_table

#: The formulation to use, and another one to compare it with; the rows are the same.
VARIANTS = ("direct", "joined")

MEASURES = ("temperature", "humidity", "pressure")


def _read(spark: SparkSession, layout: Layout, name: str, fmt: str) -> DataFrame:
    return read_table(spark, layout.data(name, fmt), fmt)


def query1(spark: SparkSession, layout: Layout, fmt: str, variant: str = "direct") -> DataFrame:
    obs = to_long(_read(spark, layout, DESCRIPTION, fmt), "description", text=True)
    how = "direct" if variant == "direct" else "cascade"
    return sunny_periods(obs, _read(spark, layout, CITIES, fmt), how=how)


def query2(spark: SparkSession, layout: Layout, fmt: str, variant: str = "direct") -> DataFrame:
    tables = {m: to_long(_read(spark, layout, m, fmt), m) for m in MEASURES}
    return monthly_stats(tables, _read(spark, layout, CITIES, fmt), method=variant)


def query3(spark: SparkSession, layout: Layout, fmt: str, variant: str = "direct") -> DataFrame:
    obs = to_long(_read(spark, layout, "temperature", fmt), "temperature")
    method = "direct" if variant == "direct" else "counting"
    return seasonal_swing(obs, _read(spark, layout, CITIES, fmt), method=method)


QUERIES: Mapping[str, Callable[..., DataFrame]] = {
    "query1": query1,
    "query2": query2,
    "query3": query3,
}


def run_matrix(
    spark: SparkSession,
    layout: Layout,
    runs: int = 1,
    formats: Iterable[str] = FORMATS,
    variants: Iterable[str] = VARIANTS,
    queries: Iterable[str] = tuple(QUERIES),
    warmup: int = WARMUP_RUNS,
) -> DataFrame:
    """Run every query in every format and variant ``runs`` times, and keep results and times.

    A run reads, computes and writes its result to ``layout.result(...)``; the time covers all
    three. The log of runs goes to ``layout.run_log(...)`` and its summary, which is returned,
    to ``layout.stats(...)``. The first ``warmup`` runs of a cell never count, so a
    cell of no more runs than that has no mean.
    """
    log = []
    for fmt in formats:
        for variant in variants:
            for name in queries:
                for run in range(1, runs + 1):
                    start = time.monotonic()
                    result = QUERIES[name](spark, layout, fmt, variant)
                    write_table(result, layout.result(name, variant, fmt, run), "csv")
                    log.append((name, fmt, variant, run, time.monotonic() - start))
    millis = int(time.time() * 1000)
    table = spark.createDataFrame(log, RUN_SCHEMA)
    table.write.parquet(layout.run_log(millis))
    summary = summarize_runs(table, warmup).orderBy("query", "format", "variant")
    write_table(summary, layout.stats(millis), "csv", single_file=True)
    return summary
