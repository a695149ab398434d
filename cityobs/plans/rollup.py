"""Monthly statistics kept as partial states that new readings merge into.

A batch of readings is aggregated once, to the count, sum, extremes and squared distances of each
measure per month and country, and these states are kept instead of the readings. Merging states
gives what all readings together would give. Reading the statistics costs as much as there are
months and countries, not readings, and a batch that comes again replaces its own states.

States of single batches lie below ``batches``. ``compact`` merges those up to a batch number into
a snapshot that notes the number; batches up to it count as merged from then on, and are ignored
when they come again.

Defined cases: a batch without readings has no states; a month that one measure lacks keeps nulls
for it; readings of cities that the dimension lacks drop out, those without a country are a group
of their own, as in ``monthly_stats``; batches come with growing numbers, and one that is repeated
after ``compact`` is taken for merged.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cityobs.functions.names import quoted
from cityobs.operators.dimension import CityDimension, city_dimension
from cityobs.plans.stats import KEYS, STATISTICS, month_rows
from cityobs.sources.snapshots import latest_snapshot, write_snapshot

STATE = ("n", "sum", "max", "min", "m2")
_BATCH = "batch"


def month_states(obs: DataFrame, dim: DataFrame | CityDimension, measures: Sequence[str]) -> DataFrame:
    """``Year, Month, Country`` and ``<part of the state>_<measure>`` of some readings."""
    states = []
    for i, m in enumerate(measures):
        value = f"value_{i}"
        n = F.count(value)
        parts = (n, F.sum(value), F.max(value), F.min(value), F.var_pop(value) * n)
        states += [part.alias(f"{name}_{m}") for part, name in zip(parts, STATE, strict=True)]
    seen = sum((quoted(f"n_{m}") for m in measures), F.lit(0))
    return month_rows(obs, city_dimension(dim), measures).groupBy(*KEYS).agg(*states).where(seen > 0)


def merge_states(states: DataFrame, measures: Sequence[str]) -> DataFrame:
    """One state per month and country. Squared distances are moved to the common mean first, so
    that nothing large is subtracted from something large."""
    whole = Window.partitionBy(*KEYS)
    counts, means, merged = {}, {}, []
    for m in measures:
        n, total, m2 = (quoted(f"{x}_{m}") for x in ("n", "sum", "m2"))
        counts[f"n_{m}"] = F.coalesce(n, F.lit(0)).cast("long")
        means[f"__mean_{m}"] = F.try_divide(F.sum(total).over(whole), F.sum(n).over(whole))
        gap = F.try_divide(total, n) - quoted(f"__mean_{m}")
        merged += [
            F.sum(n).alias(f"n_{m}"),
            F.sum(total).alias(f"sum_{m}"),
            F.max(quoted(f"max_{m}")).alias(f"max_{m}"),
            F.min(quoted(f"min_{m}")).alias(f"min_{m}"),
            F.sum(m2 + n * gap * gap).alias(f"m2_{m}"),
        ]
    return states.withColumns(counts).withColumns(means).groupBy(*KEYS).agg(*merged)


def _batches(spark: SparkSession, root: str) -> str | None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/batches")
    return f"{root}/batches" if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder) else None


def _merged_up_to(spark: SparkSession, root: str) -> int:
    base = latest_snapshot(spark, f"{root}/base")
    return base.note["up_to"] if base else -1


def add_batch(tables: Mapping[str, DataFrame], dim: DataFrame | CityDimension, root: str, batch: int) -> bool:
    """Keep the states of one batch of readings; tells whether it is new or only replaces itself.

    ``tables`` maps a measure's name to its readings, as for ``monthly_stats``; measures that share
    a table are aggregated in one pass.
    """
    shared: dict[int, tuple[DataFrame, list[str]]] = {}
    for name, obs in tables.items():
        shared.setdefault(id(obs), (obs, []))[1].append(name)
    dim = city_dimension(dim)
    spark = dim.df.sparkSession
    if batch <= _merged_up_to(spark, root):
        return False
    states = None
    for obs, measures in shared.values():
        own = month_states(obs, dim, measures)
        states = own if states is None else states.unionByName(own, allowMissingColumns=True)
    states.write.mode("overwrite").parquet(f"{root}/batches/{_BATCH}={batch}")
    return True


def states(spark: SparkSession, root: str, measures: Sequence[str]) -> DataFrame:
    """The merged states of all batches so far."""
    base = latest_snapshot(spark, f"{root}/base")
    kept = base.read(spark) if base else None
    if path := _batches(spark, root):
        new = spark.read.option("mergeSchema", True).parquet(path)
        new = new.where(F.col(_BATCH) > (base.note["up_to"] if base else -1)).drop(_BATCH)
        kept = new if kept is None else kept.unionByName(new, allowMissingColumns=True)
    if kept is None:
        raise FileNotFoundError(f"no states below {root}")
    lacking = [f"{x}_{m}" for m in measures for x in STATE if f"{x}_{m}" not in kept.columns]
    kept = kept.withColumns({c: F.lit(None).cast("double") for c in lacking}) if lacking else kept
    return merge_states(kept, measures)


def compact(spark: SparkSession, root: str, measures: Sequence[str], up_to: int) -> int:
    """Merge the batches up to a number into one table of states; its readers see it whole or not at all.

    Batches after ``up_to`` stay as they are. Tells the number of the snapshot.
    """
    base = latest_snapshot(spark, f"{root}/base")
    before = base.note["up_to"] if base else -1
    if up_to <= before:
        return base.number
    kept = base.read(spark) if base else None
    if path := _batches(spark, root):
        new = spark.read.option("mergeSchema", True).parquet(path)
        new = new.where(F.col(_BATCH).between(before + 1, up_to)).drop(_BATCH)
        kept = new if kept is None else kept.unionByName(new, allowMissingColumns=True)
    if kept is None:
        raise FileNotFoundError(f"no states below {root}")
    merged = merge_states(kept, measures)
    return write_snapshot(merged, f"{root}/base", {"up_to": up_to}, after=base.number if base else 0).number


def rolled_up_stats(spark: SparkSession, root: str, measures: Sequence[str]) -> DataFrame:
    """What ``monthly_stats`` gives for the readings of all batches."""
    columns = []
    for m in measures:
        n, total, m2 = (quoted(f"{x}_{m}") for x in ("n", "sum", "m2"))
        some = n > 0
        values = {
            "max": quoted(f"max_{m}"),
            "min": quoted(f"min_{m}"),
            "avg": F.when(some, total / n),
            "std_samp": F.when(n > 1, F.sqrt(m2 / (n - 1))),
            "std_pop": F.when(some, F.sqrt(m2 / n)),
        }
        columns += [values[s].alias(f"{s}_{m}") for s in STATISTICS]
    return states(spark, root, measures).select(*KEYS, *columns).orderBy(*KEYS)


def roll_up_arrivals(
    rows: DataFrame, measures: Sequence[str], dim: DataFrame | CityDimension, root: str, checkpoint_path: str, once: bool = True
) -> StreamingQuery:
    """Add every batch of a stream of readings ``ts, City`` and measures, under the stream's own number."""
    dim = city_dimension(dim)

    def put(batch: DataFrame, number: int) -> None:
        add_batch(dict.fromkeys(measures, batch), dim, root, number)

    writer = rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint_path)
    return (writer.trigger(availableNow=True) if once else writer).start()
