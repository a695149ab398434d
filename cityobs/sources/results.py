"""Result tables: one per query, one snapshot per variant."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityobs.sources.layout import Layout
from cityobs.sources.snapshots import drop_old_snapshots, read_snapshot, write_snapshot

_VARIANT = "variant="


def save_result(df: DataFrame, layout: Layout, query: str, variant: str) -> str:
    """Store a result under its query and variant, replacing that variant only.

    Readers get the earlier result until the new one is whole; one that has begun keeps the files
    of the earlier one. A result without rows leaves its schema and no rows of an earlier one.
    """
    path = layout.result_table(query)
    write_snapshot(df, f"{path}/{_VARIANT}{variant}")
    drop_old_snapshots(df.sparkSession, f"{path}/{_VARIANT}{variant}")
    return path


def _variants(spark: SparkSession, path: str) -> list[str]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in system.listStatus(folder)]
    return sorted(n.removeprefix(_VARIANT) for n in names if n.startswith(_VARIANT))


def load_result(
    spark: SparkSession, layout: Layout, query: str, variant: str | None = None
) -> DataFrame:
    """The latest result of one variant, or of all with a column ``variant``."""
    path = layout.result_table(query)
    if variant is not None:
        return read_snapshot(spark, f"{path}/{_VARIANT}{variant}")
    parts = [
        read_snapshot(spark, f"{path}/{_VARIANT}{v}").withColumn("variant", F.lit(v)) for v in _variants(spark, path)
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
