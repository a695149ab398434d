"""Joins against a side that is small until its size is checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityobs.scratch import materialise

#: Broadcast bounds. Both are checked against counted rows and bytes, not estimates.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

#: Pieces a key is split into when the small side turns out not to be small.
DEFAULT_SALTS = 32

_SALT = "__salt"


def broadcast_join(many: DataFrame, few: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join for a ``few`` side whose size the caller has checked."""
    return many.join(F.broadcast(few), on, how)


def salted_join(
    many: DataFrame, few: DataFrame, on: list[str], how: str = "inner", salts: int = DEFAULT_SALTS
) -> DataFrame:
    """Equi-join that spreads every key of ``many`` over ``salts`` tasks.

    Rows of ``few`` are repeated once per salt. ``how`` is ``inner`` or ``left``; each row of
    ``many`` meets exactly one copy, so the result is that of the plain join.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"salted joins are inner or left, not {how!r}")
    left = many.withColumn(_SALT, F.pmod(F.xxhash64(*many.columns), F.lit(salts)))
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
    right = few.withColumn(_SALT, copies)
    return left.join(right, [*on, _SALT], how).drop(_SALT)


def checked_join(
    many: DataFrame,
    few: DataFrame,
    on: list[str],
    few_rows: int,
    how: str = "inner",
    max_rows: int = MAX_BROADCAST_ROWS,
    row_bytes: int = 256,
) -> DataFrame:
    """Broadcast when ``few_rows`` of at most ``row_bytes`` allow it; beyond, a plain join.

    ``few_rows`` is a count or a proven bound. A plain join is what unique keys want; where a key
    of either side is heavy, adaptive execution splits its task.
    """
    if few_rows <= max_rows and few_rows * row_bytes <= MAX_BROADCAST_BYTES:
        return broadcast_join(many, few, on, how)
    return many.join(few, on, how)


def hot_keys(
    many: DataFrame, few: DataFrame, many_key: str, few_key: str, hot_rows: int
) -> DataFrame:
    """Keys with more than ``hot_rows`` rows on either side, and the pieces to cut each side into.

    Both sides are counted in one aggregation, combined in each task before the shuffle.
    """
    sides = [
        df.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.lit(k).alias("side"))
        for k, (df, key) in enumerate(((many, many_key), (few, few_key)))
    ]
    counts = sides[0].unionByName(sides[1]).groupBy("key").agg(
        *(F.count_if(F.col("side") == k).alias(n) for k, n in enumerate(("many", "few")))
    )
    pieces = [F.greatest(F.ceil(F.col(c) / hot_rows), F.lit(1)).cast("int").alias(f"{c}_pieces") for c in ("many", "few")]
    return counts.where((F.col("many") > hot_rows) | (F.col("few") > hot_rows)).select("key", *pieces)


def split_hot_join(
    many: DataFrame, few: DataFrame, many_key: str, few_key: str, hot_rows: int | None = None
) -> DataFrame:
    """Inner equi-join; with ``hot_rows``, keys with more rows than that on a side are split.

    A hot key's rows are cut into pieces of about ``hot_rows`` on each side, and every piece of one
    side meets every piece of the other once. There are at most ``rows / hot_rows`` hot keys; they
    are broadcast if that is few enough. Otherwise, and without ``hot_rows``, the join is plain
    and adaptive execution splits heavy tasks.
    """
    plain = many[many_key] == few[few_key]
    if hot_rows is None:
        return many.join(few, plain)
    hot = materialise(hot_keys(many, few, many_key, few_key, hot_rows), "hot-keys")
    found = hot.count()
    if not 0 < found <= MAX_BROADCAST_ROWS:
        return many.join(few, plain)

    def cut(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
        """Each row with its own piece, once for every piece of the other side."""
        marked = df.join(F.broadcast(hot), F.col(key) == F.col("key"), "left")
        one = F.lit(1)
        piece = F.pmod(F.xxhash64(*df.columns), F.coalesce(f"{own}_pieces", one)).cast("int")
        copies = F.explode(F.sequence(F.lit(0), F.coalesce(f"{other}_pieces", one) - 1))
        return marked.select(*df.columns, piece.alias(f"__{own}"), copies.alias(f"__{own}_{other}"))

    left, right = cut(many, many_key, "many", "few"), cut(few, few_key, "few", "many")
    match = (
        (F.col(many_key) == F.col(few_key))
        & (F.col("__many") == F.col("__few_many"))
        & (F.col("__many_few") == F.col("__few"))
    )
    return left.join(right, match).drop("__many", "__few", "__many_few", "__few_many")
