"""Statistics of timed runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# Fixed value: runs at the start of each cell that do not count.
WARMUP_RUNS = 2

RUN_SCHEMA = StructType(
    [
        StructField("query", StringType(), True),
        StructField("format", StringType(), True),
        StructField("variant", StringType(), True),
        StructField("run", IntegerType(), True),
        StructField("seconds", DoubleType(), True),
    ]
)


def summarize_runs(log: DataFrame, warmup: int = WARMUP_RUNS) -> DataFrame:
    """``query, format, variant, runs, avg, stddev`` over the runs after the warm-up, in seconds.

    Runs are numbered from 1. The deviation is that of the population. Where no run is left to
    count, ``runs`` is 0 and the others are null.
    """
    counted = F.when(F.col("run") > warmup, F.col("seconds"))
    return log.groupBy("query", "format", "variant").agg(
        F.count(counted).cast("int").alias("runs"),
        F.avg(counted).alias("avg"),
        F.stddev_pop(counted).alias("stddev"),
    )
