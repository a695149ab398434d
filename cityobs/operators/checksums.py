"""Comparison of two very large tables by a tree of checksums.

Keys are cut into ranges of their hash. The rows of a range add up to a few numbers that do not
depend on their order; each task adds up its own, so a level of the tree shuffles one row for each
range and task, whatever the tables hold. Where the numbers of both tables agree, so do the
rows, and nothing more is read of them. The others are cut again, and after the last level
only their rows are compared one by one.

Defined cases: equal tables give no ranges and no rows; repeated rows count as often as they
occur; null keys and values are values; zero has no sign; doubles that are no numbers equal each
other. Rows that differ within the tolerance make a range differ, and the comparison row by row
then leaves them out. Two ranges whose rows differ and whose count, two sums of 32-bit halves and exclusive or of
64-bit hashes all agree would be missed; that takes a coincidence of about 1 in 2 ** 64.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityobs.functions.names import quoted
from cityobs.operators.parity import parity

#: Ranges that a range is cut into on each level, as a power of two, and the number of levels.
BITS, LEVELS = 9, 3


def key_range(keys: Sequence[str], level: int, bits: int = BITS) -> Column:
    """Number of the range on a level that a row's key lies in; each is cut into ``2 ** bits`` on the next."""
    return F.shiftrightunsigned(F.xxhash64(*[quoted(k) for k in keys]), 64 - bits * level)


def range_sums(df: DataFrame, keys: Sequence[str], level: int, columns: Sequence[str] | None = None, bits: int = BITS) -> DataFrame:
    """``range`` and its rows' count and checksums."""
    row = F.xxhash64(F.lit(17), *[quoted(c) for c in columns or df.columns])
    rows = df.select(key_range(keys, level, bits).alias("range"), row.alias("h"))
    return rows.groupBy("range").agg(
        F.count("*").alias("rows"),
        F.sum(F.shiftrightunsigned("h", 32)).alias("high"),
        F.sum(F.col("h").bitwiseAND(0xFFFFFFFF)).alias("low"),
        F.bit_xor("h").alias("mixed"),
    )


def differing_ranges(a: DataFrame, b: DataFrame, keys: Sequence[str], level: int, bits: int = BITS) -> list[int]:
    """Ranges of a level whose rows are not the same on both sides."""
    sides = [range_sums(df, keys, level, a.columns, bits).withColumn("__a", F.lit(k == 0)) for k, df in enumerate((a, b))]
    values = ["rows", "high", "low", "mixed"]
    met = sides[0].unionByName(sides[1]).groupBy("range").agg(
        *[F.max(F.when(F.col("__a"), F.col(v))).alias(f"{v}_a") for v in values],
        *[F.max(F.when(~F.col("__a"), F.col(v))).alias(f"{v}_b") for v in values],
    )
    same = reduce(lambda x, y: x & y, [F.col(f"{v}_a").eqNullSafe(F.col(f"{v}_b")) for v in values])
    return [r[0] for r in met.where(~same).select("range").collect()]


def _within(df: DataFrame, keys: Sequence[str], level: int, ranges: list[int], bits: int) -> DataFrame:
    """Rows whose range is one of those; a broadcast semi-join, as there may be some thousands."""
    wanted = df.sparkSession.createDataFrame([(r,) for r in ranges], "__range long")
    marked = df.withColumn("__in", key_range(keys, level, bits))
    return marked.join(F.broadcast(wanted), F.col("__in") == F.col("__range"), "left_semi").drop("__in")


def parity_by_ranges(
    a: DataFrame,
    b: DataFrame,
    keys: Sequence[str],
    tolerance: Mapping[str, float] | float = 0.0,
    bits: int = BITS,
    levels: int = LEVELS,
) -> DataFrame:
    """As ``parity``, without shuffling the rows of ranges that are equal.

    Descends while less than half of the ranges of a level differ and their number stays below
    ``2 ** (2 * bits)``; then the rows that are left are compared.
    """
    keys = list(keys)
    if missing := set(a.columns) ^ set(b.columns):
        raise ValueError(f"columns on one side only: {sorted(missing)}")
    left, right, looked = a, b, 1
    for level in range(1, levels + 1):
        ranges = differing_ranges(left, right, keys, level, bits)
        left, right = (_within(df, keys, level, ranges, bits) for df in (a, b))
        looked <<= bits
        if 2 * len(ranges) >= looked or len(ranges) << bits > 1 << 2 * bits:
            break
        looked = len(ranges)
        if not ranges:
            break
    return parity(left, right, keys, tolerance)
