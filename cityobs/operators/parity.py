"""Row-level comparison of two results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cityobs.functions.names import quoted

# Fixed value: allowed gap between means and deviations of two formulations.
TOLERANCE = 0.005


def parity(
    a: DataFrame,
    b: DataFrame,
    keys: Sequence[str],
    tolerance: Mapping[str, float] | float = 0.0,
) -> DataFrame:
    """Where ``a`` and ``b`` differ: the key, its number of rows on each side, and both values.

    Equal results give no rows. Rows that are equal on both sides cancel out, as often as they occur
    on both; they are counted before the shuffle, so a row that is repeated very often is one. What is
    left of a key on each side is numbered in the order of its values and compared place by place,
    within the tolerance; a place that only one side has is a difference.
    """
    keys = list(keys)
    values = [c for c in a.columns if c not in keys]
    missing = set(a.columns) ^ set(b.columns)
    if missing:
        raise ValueError(f"columns on one side only: {sorted(missing)}")
    tolerances = tolerance if isinstance(tolerance, Mapping) else dict.fromkeys(values, tolerance)
    both = a.withColumn("__a", F.lit(True)).unionByName(b.withColumn("__a", F.lit(False)))
    key = [quoted(k) for k in keys]
    counted = both.groupBy(*[quoted(c) for c in a.columns]).agg(
        F.count_if(F.col("__a")).alias("__in_a"), F.count_if(~F.col("__a")).alias("__in_b")
    )
    whole = Window.partitionBy(*key)
    totals = {f"rows_{s}": F.sum(f"__in_{s}").over(whole) for s in ("a", "b")}
    left = (
        counted.withColumns(totals)
        .withColumn("__more", F.col("__in_a") - F.col("__in_b"))
        .where(F.col("__more") != 0)
    )
    ahead = F.col("__more") > 0
    order = Window.partitionBy(*key, ahead).orderBy(*[quoted(v) for v in values])
    last = F.sum(F.abs("__more")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    places = F.explode(F.sequence(F.col("__last") - F.abs("__more") + 1, F.col("__last")))
    numbered = left.withColumn("__last", last).withColumn("__place", places)

    sides = {"a": ahead, "b": ~ahead}
    cells = [F.count_if(side).alias(f"__at_{s}") for s, side in sides.items()]
    cells += [F.max(F.when(side, quoted(v))).alias(f"{v}_{s}") for v in values for s, side in sides.items()]
    pairs = numbered.groupBy(*key, "__place", *totals).agg(*cells)

    differs = F.col("__at_a") != F.col("__at_b")
    for v in values:
        left_value, right_value = quoted(f"{v}_a"), quoted(f"{v}_b")
        unequal = ~left_value.eqNullSafe(right_value)
        if gap := tolerances.get(v, 0.0):
            one_null = left_value.isNull() | right_value.isNull()
            unequal = unequal & (one_null | (F.abs(left_value - right_value) > gap))
        differs = differs | unequal
    shown = [quoted(f"{v}_{s}") for v in values for s in sides]
    return pairs.where(differs).select(*key, *totals, *shown)
