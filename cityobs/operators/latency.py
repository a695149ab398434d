"""How long files take from arrival to delivery.

Events have columns ``event_type, flow_uuid, attr_uuid, filename, event_time_ms, duration_ms``.
A RECEIVE marks a file's arrival under ``flow_uuid``; every SEND with that uuid in ``attr_uuid``
marks a delivery, done ``duration_ms`` after its event time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from cityobs.functions.localtime import epoch_seconds
from cityobs.operators.joins import split_hot_join
from cityobs.scratch import materialise

DAY_MILLIS = 86_400_000

# The fields of an elapsed record.
ELAPSED_SCHEMA = StructType(
    [
        StructField("filename", StringType(), True),
        StructField("timestamp", StringType(), True),
        StructField("elapsed", DoubleType(), True),
    ]
)


def arrivals(events: DataFrame, *more: Column) -> DataFrame:
    """``flow_uuid, start`` of every arrival, and what else is asked for."""
    return events.where((F.col("event_type") == "RECEIVE") & F.col("flow_uuid").isNotNull()).select(
        "flow_uuid", F.col("event_time_ms").alias("start"), *more
    )


def deliveries(events: DataFrame, *more: Column) -> DataFrame:
    """``attr_uuid, filename, end`` of every delivery, and what else is asked for."""
    return events.where((F.col("event_type") == "SEND") & F.col("attr_uuid").isNotNull()).select(
        "attr_uuid", "filename", (F.col("event_time_ms") + F.col("duration_ms")).alias("end"), *more
    )


def elapsed(pairs: DataFrame) -> DataFrame:
    """Elapsed records of pairs with ``filename, start, end``."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    start = F.timestamp_add("SECOND", F.floor(F.col("start") / 1000), epoch)
    return pairs.select(
        "filename",
        start.cast("string").alias("timestamp"),
        ((F.col("end") - F.col("start")) / 1000).alias("elapsed"),
    )


def millis(ts: Column) -> Column:
    """Milliseconds from 1970 of a time without a zone, for events that carry such a time."""
    within = F.floor(F.date_part(F.lit("SECOND"), ts) * 1000).cast("long") % 1000
    return epoch_seconds(ts) * 1000 + within


def pair_events(events: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """One record ``filename, timestamp, elapsed`` (seconds) for every delivery of an arrival.

    Adaptive execution splits uuids that make a task too large; ``hot_rows`` splits, on either
    side, every uuid with more rows than that.
    """
    return elapsed(split_hot_join(deliveries(events), arrivals(events), "attr_uuid", "flow_uuid", hot_rows))


def latency_by_file(records: DataFrame) -> DataFrame:
    """``filename, avg, stddev, count`` of elapsed records, deviation of the population."""
    return records.groupBy("filename").agg(
        F.avg("elapsed").alias("avg"),
        F.stddev_pop("elapsed").alias("stddev"),
        F.count("elapsed").alias("count"),
    )


def _moments(time: str, side: str) -> list[Column]:
    """Count, mean and variance of times. The mean is kept as days and the rest of a day, as the
    sum of very many whole times would lose milliseconds."""
    day = F.floor(F.col(time) / DAY_MILLIS)
    return [
        F.count("*").alias(f"n_{side}"),
        F.avg(day).alias(f"day_{side}"),
        F.avg(F.col(time) - day * DAY_MILLIS).alias(f"rest_{side}"),
        F.var_pop(time).alias(f"var_{side}"),
    ]


def ingest_latency(events: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """``latency_by_file(pair_events(events))`` without making the pairs.

    Every arrival of a uuid meets every delivery of it, so over those pairs the mean elapsed time
    is the difference of the means and its variance the sum of the variances. Both sides are
    aggregated by uuid first; what is joined and pooled by file name is one row per uuid and name.
    Pooling is centred: the mean of a name comes first, and the distances of its uuids' means to
    it are squared, so that a long delay does not swallow a small spread.
    """
    came = arrivals(events).groupBy("flow_uuid").agg(*_moments("start", "in"))
    went = deliveries(events).groupBy("attr_uuid", "filename").agg(*_moments("end", "out"))
    joined = split_hot_join(went, came, "attr_uuid", "flow_uuid", hot_rows)
    days = F.col("day_out") - F.col("day_in")
    rest = F.col("rest_out") - F.col("rest_in")
    per_uuid = materialise(
        joined.select(
            "filename",
            (F.col("n_in") * F.col("n_out")).alias("n"),
            days.alias("days"),
            rest.alias("rest"),
            (F.col("var_out") + F.col("var_in")).alias("var"),
        ),
        "latency",
    )
    n = F.sum("n")
    means = per_uuid.groupBy(F.col("filename").alias("name")).agg(
        n.alias("count"),
        (F.sum(F.col("n") * F.col("days")) / n).alias("mean_days"),
        (F.sum(F.col("n") * F.col("rest")) / n).alias("mean_rest"),
    )
    pooled = per_uuid.join(means, F.col("filename").eqNullSafe(F.col("name")))
    gap = (F.col("days") - F.col("mean_days")) * DAY_MILLIS + (F.col("rest") - F.col("mean_rest"))
    square = F.sum(F.col("n") * (F.col("var") + gap * gap)) / F.first("count")
    mean = F.first("mean_days") * (DAY_MILLIS // 1000) + F.first("mean_rest") / 1000
    return pooled.groupBy("filename").agg(
        mean.alias("avg"),
        (F.sqrt(square) / 1000).alias("stddev"),
        F.first("count").cast("long").alias("count"),
    )
