"""How long files take, told while events are still coming in.

Arrivals and deliveries are two streams joined by uuid. Each side is kept as state until the
watermark says that no partner can come any more: a delivery that happens ``longest`` after its
arrival at most, and an event that comes ``lateness`` after others of its time at most. The
watermark is that of the slower side, and begins at 1970. The state
is therefore bounded by the events of that time, not by those of all time, and a restarted query
goes on from its checkpoint without reading the event log again.

The report is kept as state as well: count, mean and squared distances of each file name, which
merge with those of new records. Every batch writes the names that it changed, below a folder of
its own number, so that a batch repeated after a failure replaces what it wrote.

Every batch costs a task and a commit to the checkpoint for each part of the state, however few rows
it has, and Spark does not coalesce such parts. Their number is fixed by a checkpoint's first run:
``state_partitions``, or the session's shuffle partitions, which are made for larger tables.

Defined cases: an event later than the watermark allows is left out of the pairs, and
``dropped_as_late`` tells how many; a delivery before its arrival or more than ``longest`` after it
makes no pair; a null uuid pairs with nothing; repeated events make a pair each, as in a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cityobs.operators.latency import arrivals, deliveries, elapsed, latency_by_file
from cityobs.streaming.arrivals import BATCH

# Fixed value: columns of an event.
EVENT_SCHEMA = (
    "event_type string, flow_uuid string, event_time_ms long, duration_ms long, attr_uuid string, filename string"
)


# Fixed value: the setting that gives the parts of a new checkpoint's state.
PARTITIONS = "spark.sql.shuffle.partitions"


@contextmanager
def _state_in(spark: SparkSession, partitions: int | None) -> Iterator[None]:
    """Queries started within keep their state in so many parts; the session's setting comes back after."""
    before = spark.conf.get(PARTITIONS)
    if partitions:
        spark.conf.set(PARTITIONS, partitions)
    try:
        yield
    finally:
        spark.conf.set(PARTITIONS, before)


def arriving_events(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Events of the Parquet files below ``path``, those to come included."""
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def pair_arriving(events: DataFrame, lateness: str = "1 hour", longest: str = "1 day") -> DataFrame:
    """Elapsed records of a stream of events: ``pair_events`` within the time that is waited for."""
    happened = F.timestamp_millis("event_time_ms")
    came = arrivals(events, happened.alias("arrived")).withWatermark("arrived", lateness)
    went = deliveries(events, happened.alias("delivered")).withWatermark("delivered", lateness)
    in_time = (F.col("delivered") >= F.col("arrived")) & (F.col("delivered") <= F.col("arrived") + F.expr(f"INTERVAL {longest}"))
    return elapsed(went.join(came, (F.col("attr_uuid") == F.col("flow_uuid")) & in_time))


def pair_arrivals(
    events: DataFrame,
    out_path: str,
    checkpoint_path: str,
    lateness: str = "1 hour",
    longest: str = "1 day",
    once: bool = True,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Pairs of arriving events as Parquet records below ``out_path``; ``once`` stops after the files there are now."""
    records = pair_arriving(events, lateness, longest)
    writer = records.writeStream.format("parquet").outputMode("append").option("path", out_path)
    writer = writer.option("checkpointLocation", checkpoint_path)
    with _state_in(events.sparkSession, state_partitions):
        return (writer.trigger(availableNow=True) if once else writer).start()


def dropped_as_late(query: StreamingQuery) -> int:
    """Events that the query's batches so far left out as they came too late."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p["stateOperators"])


def running_latency(
    records: DataFrame,
    out_path: str,
    checkpoint_path: str,
    once: bool = True,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Keep ``latency_by_file`` of arriving records up to date below ``out_path``."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/{BATCH}={number}")

    writer = latency_by_file(records).writeStream.outputMode("update").foreachBatch(put)
    writer = writer.option("checkpointLocation", checkpoint_path)
    with _state_in(records.sparkSession, state_partitions):
        return (writer.trigger(availableNow=True) if once else writer).start()


def read_running_latency(spark: SparkSession, out_path: str) -> DataFrame:
    """The report as the last batch left it: for each file name the row of its latest batch."""
    rows = spark.read.parquet(out_path)
    values = [c for c in rows.columns if c not in ("filename", BATCH)]
    latest = rows.groupBy("filename").agg(F.max(F.struct(BATCH, *values)).alias("latest"))
    return latest.select("filename", *[F.col(f"latest.{c}").alias(c) for c in values])
