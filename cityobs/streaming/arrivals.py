"""Cleaning files as they arrive.

Cleaning looks at one row at a time and keeps no state, so the batch functions run unchanged on
a stream; files that arrived while nothing ran are taken up by the next run, each exactly once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cityobs.sources.tables import read_table, text_schema

#: Partition column of what batches write.
BATCH = "batch"


# Fixed value: columns of a stream of files; only the path is read.
FILES = "path string, modificationTime timestamp, length long, content binary"


def arriving_rows(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: StructType | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Rows of the files below ``path``, those to come included, all of one schema.

    A stream needs its schema in advance. For CSV the header of the files already there gives the
    column names, all as text; a file with another header stops the stream. Files whose headers
    differ are for ``clean_arriving_files``.
    """
    if schema is None:
        there = read_table(spark, path, fmt)
        schema = text_schema(there.columns) if fmt == "csv" else there.schema
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def clean_arrivals(
    rows: DataFrame,
    clean: Callable[[DataFrame], DataFrame],
    out_path: str,
    checkpoint_path: str,
    fmt: str = "parquet",
    once: bool = True,
) -> StreamingQuery:
    """Clean arriving rows into ``out_path``; ``once`` stops after the files there are now.

    ``checkpoint_path`` remembers which files are done and must be on shared storage.
    """
    writer = clean(rows).writeStream.format(fmt).outputMode("append")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer = writer.option("path", out_path).option("checkpointLocation", checkpoint_path)
    return (writer.trigger(availableNow=True) if once else writer).start()


def clean_arriving_files(
    spark: SparkSession,
    path: str,
    clean: Callable[[DataFrame], DataFrame],
    out_path: str,
    checkpoint_path: str,
    files_per_batch: int = 1000,
    once: bool = True,
) -> StreamingQuery:
    """Clean arriving CSV files, each under its own header, into Parquet below ``out_path``.

    The stream carries the files' paths only; a batch of them is read like any table. A batch that
    is repeated after a failure replaces what it wrote. ``read_cleaned`` reads the result.
    """
    files = spark.readStream.format("binaryFile").schema(FILES).option("maxFilesPerTrigger", files_per_batch)

    def take(batch: DataFrame, number: int) -> None:
        paths = [r["path"] for r in batch.select("path").collect()]  # files_per_batch at most
        if paths:
            cleaned = clean(read_table(batch.sparkSession, paths, "csv"))
            cleaned.write.mode("overwrite").parquet(f"{out_path}/{BATCH}={number}")

    writer = files.load(path).select("path").writeStream.foreachBatch(take)
    writer = writer.option("checkpointLocation", checkpoint_path)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_cleaned(spark: SparkSession, out_path: str) -> DataFrame:
    """What ``clean_arriving_files`` has written; columns that a batch lacks are null in its rows."""
    return spark.read.option("mergeSchema", True).parquet(out_path).drop(BATCH)
