"""Format-neutral reading and writing of tables."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from cityobs.functions.names import identifier, quoted, to_underscores
from cityobs.sources.layout import Layout

FORMATS = ("csv", "parquet", "avro")

# Fixed value: the time layout used in every text table.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

#: Name of the partition column that ``write_table(by_year=True)`` adds.
YEAR_COLUMN = "utc_year"


class FormatUnavailable(RuntimeError):
    """The format is known, but its Spark module is not on the class path."""


def _known(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}, expected one of {FORMATS}")
    return fmt


def _absent(error: AnalysisException, fmt: str) -> bool:
    return fmt == "avro" and "avro" in str(error).lower() and "PATH_NOT_FOUND" not in str(error)


def csv_headers(spark: SparkSession, path: str | Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Files below ``path`` by the header that each of them begins with.

    Only first lines are read, through the file system that the path names. Empty files have none.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    found: dict[tuple[str, ...], list[str]] = {}
    for name in sorted(spark.read.text(path if isinstance(path, str) else list(path)).inputFiles()):
        file = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        codec, stream = codecs.getCodec(file), file.getFileSystem(conf).open(file)
        stream = codec.createInputStream(stream) if codec is not None else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        try:
            line = reader.readLine()
        finally:
            reader.close()
        if line:
            found.setdefault(tuple(next(csv.reader([line]))), []).append(name)
    return found


def _read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | None) -> DataFrame:
    """Every file under its own header; columns that a file lacks are null in its rows."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
    if schema is not None:
        return reader.schema(schema).csv(path)
    headers = csv_headers(spark, path)
    if not headers:
        return reader.csv(path)
    parts = [reader.schema(text_schema(names)).csv(files) for names, files in headers.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_table(
    spark: SparkSession, path: str | Sequence[str], fmt: str, schema: StructType | None = None
) -> DataFrame:
    """Read a table. Text columns of a CSV stay text: the header gives names, never types.

    CSV files of one table may differ in the order and set of their columns. With a ``schema``, a
    file whose header is another one is an error.
    """
    if _known(fmt) == "csv":
        return _read_csv(spark, path, schema)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as error:
        if _absent(error, fmt):
            raise FormatUnavailable("reading avro needs the spark-avro module") from error
        raise


def text_schema(columns: Iterable[str]) -> StructType:
    """All-text schema for a header that is already known, e.g. for a stream."""
    return StructType([StructField(name, StringType(), True) for name in columns])


def _whole_seconds(field: StructField) -> Column:
    column = quoted(field.name)
    if not isinstance(field.dataType, TimestampNTZType):
        return column
    whole = column.isNull() | (F.date_trunc("second", column) == column)
    refused = F.raise_error(F.concat(F.lit("a text table holds no fraction of a second: "), column.cast("string")))
    return F.when(whole, column).otherwise(refused.cast("timestamp_ntz")).alias(field.name)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str,
    *,
    mode: str = "errorifexists",
    single_file: bool = False,
    by_year: bool = False,
    files_per_year: int | None = None,
) -> None:
    """Write a table; an existing path is an error unless ``mode`` says otherwise.

    ``by_year`` partitions by the year of the first column, so that a time range prunes whole
    directories. ``files_per_year`` spreads each year over that many tasks, never over one.
    ``single_file`` is for small results only: one task writes everything. Times in text have no
    fractions of a second; writing one that has is an error.
    """
    if by_year:
        time_col = df.columns[0]
        df = df.withColumn(YEAR_COLUMN, F.year(quoted(time_col)))
        if files_per_year:
            spread = F.pmod(F.xxhash64(quoted(time_col)), F.lit(files_per_year))
            df = df.repartition(YEAR_COLUMN, spread)
    elif single_file:
        df = df.repartition(1)
    if _known(fmt) == "avro":
        df = to_underscores(df)
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = df.select(*[_whole_seconds(f) for f in df.schema]).write.mode(mode)
        writer = writer.option("header", True).option("timestampNTZFormat", TIME_FORMAT)
    if by_year:
        writer = writer.partitionBy(YEAR_COLUMN)
    try:
        writer.format(fmt).save(path)
    except AnalysisException as error:
        if _absent(error, fmt):
            raise FormatUnavailable("writing avro needs the spark-avro module") from error
        raise


def publish(
    df: DataFrame,
    layout: Layout,
    name: str,
    formats: Iterable[str] = FORMATS,
    *,
    by_year: bool = False,
    files_per_year: int | None = None,
) -> dict[str, str]:
    """Write one cleaned table in several formats and return the path of each.

    Parquet goes first; the other formats are written from it, so the cleaning runs once.
    Header names lose their spaces in every tree, as Avro field names require. ``by_year``
    partitions the Parquet tree.
    """
    wanted = [_known(fmt) for fmt in formats]
    spark = df.sparkSession
    df = to_underscores(df)
    paths: dict[str, str] = {}
    for fmt in sorted(wanted, key=lambda f: f != "parquet"):
        path = layout.data(name, fmt)
        if fmt == "parquet":
            write_table(df, path, fmt, by_year=by_year, files_per_year=files_per_year)
            df = read_table(spark, path, fmt).select(*[identifier(c) for c in df.columns])
        else:
            write_table(df, path, fmt)
        paths[fmt] = path
    return paths
