"""Reproducible shuffle into shards: a Feistel permutation of global row numbers with cycle walking.

Rows are numbered 0 to n-1 in an order that only their contents decide (a hash of the id, then id,
size and checksum). A Feistel network permutes the smallest rectangle of numbers that holds n;
numbers that land outside are permuted again until they are inside. The permuted number gives shard
(remainder) and slot (quotient), so shard sizes differ by one row at most and anyone who knows n,
the seed and a row's number can compute its place.

Defined cases: a null text has size 1 (no bytes, plus 1) and the checksum of an empty one; null ids
are numbered like any other value; rows equal in id, size and checksum get different numbers, and
which of them gets which makes no difference; an empty table gives an empty table; other columns
are not read.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityobs.scratch import materialise

ROUNDS = 6
SEED = 20_240_607
#: Hex digits of the hash that deals rows to numbering tasks: 4,096 buckets.
BUCKET_DIGITS = 3
#: Copies of one row that a numbering task takes as one.
COPIES = 100_000


def rectangle(total: int) -> tuple[int, int]:
    """Sides of the domain: fewer than one side's numbers lie outside ``total``."""
    a = max(1, math.isqrt(max(total, 1) - 1) + 1)
    return a, max(1, -(-total // a))


def permuted(number: int, total: int, seed: int = SEED) -> int:
    """One pass of the network, in plain Python; may land outside ``total``."""
    a, b = rectangle(total)
    left, right = divmod(number, b)
    for k in range(ROUNDS):
        value = right if k % 2 == 0 else left
        drawn = int(hashlib.md5(f"{seed}:{k}:{value}".encode()).hexdigest()[:8], 16)
        if k % 2 == 0:
            left = (left + drawn) % a
        else:
            right = (right + drawn) % b
    return left * b + right


def place(number: int, total: int, shards: int, seed: int = SEED) -> tuple[int, int]:
    """Shard and slot of a row number."""
    value = permuted(number, total, seed)
    while value >= total:
        value = permuted(value, total, seed)
    return value % shards, value // shards


def longest_walk(total: int, seed: int = SEED) -> int:
    """Passes that no row needs more of. Only the numbers outside, fewer than a side, are tried."""
    a, b = rectangle(total)
    longest = 0
    for start in range(total, a * b):
        steps, value = 1, permuted(start, total, seed)
        while value >= total and value != start:
            steps, value = steps + 1, permuted(value, total, seed)
        longest = max(longest, steps)
    return longest + 1


def permuted_column(number: Column, total: int, seed: int = SEED) -> Column:
    """The permutation with its walk, as one expression."""
    a, b = rectangle(total)
    walks = longest_walk(total, seed)

    def step(state: Column, i: Column) -> Column:
        k = i % ROUNDS
        even = k % 2 == 0
        inside = state["l"] * b + state["r"] < total
        done = state["done"] | ((i > 0) & (k == 0) & inside)
        value = F.when(even, state["r"]).otherwise(state["l"])
        text = F.concat_ws(":", F.lit(str(seed)), k.cast("string"), value.cast("string"))
        drawn = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")
        return F.struct(
            F.when(done | ~even, state["l"]).otherwise((state["l"] + drawn) % a).alias("l"),
            F.when(done | even, state["r"]).otherwise((state["r"] + drawn) % b).alias("r"),
            done.alias("done"),
        )

    quotient = F.call_function("div", number - number % b, F.lit(b).cast("long"))
    start = F.struct(quotient.alias("l"), (number % b).cast("long").alias("r"), F.lit(False).alias("done"))
    steps = F.sequence(F.lit(0), F.lit(walks * ROUNDS - 1))
    return F.aggregate(steps, start, step, lambda s: s["l"] * b + s["r"])


def numbered(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> tuple[DataFrame, int]:
    """Id, size and checksum of each row with its global row number, and the number of rows.

    Equal rows are counted before the shuffle. Numbers are sums within 4,096 hash buckets on top of
    the buckets' sums, so no task sorts more than a bucket and only the buckets' sums meet.
    """
    raw = F.coalesce(F.col(text), F.lit(""))
    copies = (
        df.select(
            F.col(id_col),
            (F.octet_length(raw) + F.lit(1)).cast("long").alias("size"),
            F.crc32(raw.cast("binary")).alias("text_crc32"),
        )
        .groupBy(id_col, "size", "text_crc32")
        .agg(F.count("*").alias("__n"))
    )
    parts = copies.withColumn("__part", F.explode(F.sequence(F.lit(0), F.expr(f"int((__n - 1) div {COPIES})"))))
    key = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col("__part").cast("string"))
    dealt = materialise(
        parts.select(
            id_col,
            "size",
            "text_crc32",
            "__part",
            F.least(F.lit(COPIES), F.col("__n") - F.col("__part") * COPIES).cast("long").alias("__rows"),
            F.substring(F.md5(key.cast("binary")), 1, BUCKET_DIGITS).alias("__bucket"),
        ),
        "numbered",
    )
    sums = dealt.groupBy("__bucket").agg(F.sum("__rows").alias("__sum"))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("__bucket", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__offset"))
    within = (
        Window.partitionBy("__bucket")
        .orderBy(F.col(id_col).asc_nulls_first(), "size", "text_crc32", "__part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    total = sums.agg(F.sum("__sum")).first()[0] or 0
    started = dealt.withColumn("__before", F.coalesce(F.sum("__rows").over(within), F.lit(0)))
    rows = started.join(F.broadcast(offsets), "__bucket").select(  # 4,096 buckets at most
        id_col,
        "size",
        "text_crc32",
        (F.col("__offset") + F.col("__before")).alias("__first"),
        F.explode(F.sequence(F.lit(0), (F.col("__rows") - 1).cast("int"))).alias("__copy"),
    )
    return rows.select(id_col, "size", "text_crc32", (F.col("__first") + F.col("__copy")).alias("row_number")), total


def shard(df: DataFrame, shards: int = 16, seed: int = SEED, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, size, checksum, row number, shard and slot of every row."""
    rows, total = numbered(df, id_col, text)
    return (
        rows.withColumn("__to", permuted_column(F.col("row_number"), total, seed))
        .withColumn("shard", (F.col("__to") % shards).cast("int"))
        .withColumn("slot", F.expr(f"__to div {shards}"))
        .drop("__to")
    )
