"""Where intermediate tables go.

A cluster names a folder every executor can reach in ``spark.checkpoint.dir``; that setting is read
and never replaced. Where it is unset, a folder below the warehouse is used, which executors share
as well. Each application writes below a folder of its own, which goes when its JVM ends.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def scratch_dir(spark: SparkSession) -> str:
    context = spark.sparkContext
    configured = spark.conf.get(SETTING, None) or context.getCheckpointDir()
    if not configured:
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


def _own_dir(spark: SparkSession) -> str:
    """This application's folder, removed by the file system when the JVM ends."""
    jvm, context = spark._jvm, spark.sparkContext
    folder = f"{scratch_dir(spark)}/cityobs-{context.applicationId}"
    path = jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        system.mkdirs(path)
        system.deleteOnExit(path)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the application's folder."""
    return f"{_own_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and go on from the written table, so later reads do not repeat the work."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
