"""Ranks and top-k within groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cityobs.operators.joins import checked_join
from cityobs.scratch import materialise


def rank_within(
    df: DataFrame, group: list[str], value: str, name: str, tie: str = "City"
) -> DataFrame:
    """Place of each row in its group, largest ``value`` first, equal values by ``tie``.

    A null value has no place. A group is sorted in one task; ``rank_spread`` is for groups of any
    size.
    """
    order = Window.partitionBy(*group).orderBy(F.desc_nulls_last(value), tie)
    return df.withColumn(name, F.when(F.col(value).isNotNull(), F.row_number().over(order)))


def rank_spread(
    df: DataFrame, group: list[str], value: str, name: str, tie: str = "City"
) -> DataFrame:
    """As ``rank_within``, for groups of any size.

    Rows are dealt to tasks by ranges of group, value and tie, so a large group lies in many tasks.
    A row's place is the rows of its group in earlier ranges, which are counted, and those before it
    in its own.
    """
    order = [F.desc_nulls_last(value), F.col(tie)]
    dealt = materialise(
        df.repartitionByRange(*group, *order).withColumn("__range", F.spark_partition_id()), "ranges"
    )
    valued = dealt.where(F.col(value).isNotNull())
    key = F.struct(*group, "__range")
    counts = valued.groupBy(*group, "__range").agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(key.alias("__key"), F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    own = F.row_number().over(Window.partitionBy(*group, "__range").orderBy(*order))
    placed = valued.withColumn("__own", own).withColumn("__key", key).join(before, "__key")
    found = placed.select(*df.columns, (F.col("__before") + F.col("__own")).cast("int").alias(name))
    without = dealt.where(F.col(value).isNull()).select(*df.columns, F.lit(None).cast("int").alias(name))
    return found.unionByName(without)


def top_within(
    df: DataFrame, group: list[str], value: str, k: int, name: str = "place", tie: str = "City"
) -> DataFrame:
    """The ``k`` rows of each group with the largest ``value``.

    Every task keeps at most ``k`` rows of a group before the shuffle, so a group of any size
    reaches its window as ``k`` rows per task.
    """
    order = Window.partitionBy(*group).orderBy(F.desc(value), tie)
    placed = df.where(F.col(value).isNotNull()).withColumn(name, F.row_number().over(order))
    return placed.where(F.col(name) <= k)


def rank_of_picks(
    df: DataFrame,
    picks: DataFrame,
    group: list[str],
    value: str,
    name: str,
    tie: str = "City",
    picks_bound: int | None = None,
) -> DataFrame:
    """Place of each of a few ``picks`` among all rows of ``df``, without sorting the groups.

    The place is one more than the number of rows of the group that come earlier, and that is a
    count, combined in each task before the shuffle. Picks without a ``value`` drop out. A null
    group is a group. ``picks_bound`` is how many picks there are at most, if that is known.
    """
    picks = picks.where(F.col(value).isNotNull())
    key = F.struct(*group).alias("__group")  # fields that are null on both sides are equal in it
    few = picks.select(key, F.col(value).alias("__value"), F.col(tie).alias("__tie"))
    others = df.select(key, value, tie).where(F.col(value).isNotNull())
    pairs = checked_join(others, few, ["__group"], few.count() if picks_bound is None else picks_bound)
    earlier = (F.col(value) > F.col("__value")) | (
        (F.col(value) == F.col("__value")) & (F.col(tie) < F.col("__tie"))
    )
    places = pairs.groupBy("__group", "__tie").agg((F.count_if(earlier) + 1).cast("int").alias(name))
    keyed = picks.withColumn("__group", key)
    return keyed.join(places, (keyed["__group"] == places["__group"]) & (keyed[tie] == places["__tie"])).select(
        *picks.columns, name
    )
