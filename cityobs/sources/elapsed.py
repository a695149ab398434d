"""Elapsed-time records as JSON, and the latency report as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cityobs.operators.latency import ELAPSED_SCHEMA
from cityobs.sources.tables import write_table

# Fixed value: header of the latency report.
REPORT_HEADER = ("filename", "avg", "stddev", "count")

#: Records of a JSON list, at most.
LIST_RECORDS = 10_000


def read_elapsed(spark: SparkSession, path: str, json_list: bool = False) -> DataFrame:
    """Records ``filename, timestamp, elapsed``.

    ``json_list`` reads files that hold one JSON list each; such a file cannot be split, so large
    amounts belong in one record per line, which is what ``write_elapsed`` writes.
    """
    return spark.read.schema(ELAPSED_SCHEMA).option("multiLine", json_list).json(path)


def write_elapsed(records: DataFrame, path: str, mode: str = "errorifexists") -> None:
    records.select(*ELAPSED_SCHEMA.names).write.mode(mode).json(path)


def write_elapsed_lists(records: DataFrame, path: str, most: int | None = None) -> None:
    """Files that hold one JSON list each, of one file name and at most ``most`` records.

    A file name has as many parts as its count needs; a part that the hash deals more records to is
    cut into several lists by number, so the bound holds for any records, equal ones too.
    """
    most = most or LIST_RECORDS
    names = ELAPSED_SCHEMA.names
    kept = records.select(*names)
    counts = kept.groupBy(F.col("filename").alias("__name")).agg(F.ceil(F.count("*") / most).alias("__parts"))
    part = F.pmod(F.xxhash64(*names), F.col("__parts"))
    met = kept.join(counts, F.col("filename").eqNullSafe(F.col("__name"))).select(*names, part.alias("__part"))
    at = F.row_number().over(Window.partitionBy("filename", "__part").orderBy("timestamp", "elapsed"))
    dealt = met.withColumn("__list", F.floor((at - 1) / most))
    lists = dealt.groupBy("filename", "__part", "__list").agg(F.to_json(F.collect_list(F.struct(*names))).alias("value"))
    file = F.concat_ws("-", "filename", "__part", "__list").alias("file")
    lists.select(file, "value").write.partitionBy("file").text(path)


def write_latency(report: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Report with its fixed header."""
    write_table(report.select(*REPORT_HEADER), path, "csv", mode=mode)
