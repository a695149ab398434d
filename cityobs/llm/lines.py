"""Removal of boilerplate lines by the number of distinct sites that carry them.

One HyperLogLog sketch of sites per line hash, merged by aggregation, gives every line's spread.
Lines well above the threshold are boilerplate; lines near it are counted exactly. A boilerplate
line stays in the document of the smallest id that holds it and goes from all others, so nothing
is lost altogether, and of copied documents one keeps its text.

Lines are compared without the spaces around them, by two 64-bit hashes; blank lines are kept and
count as no line. Defined cases: a null text is an empty one; a null site is one site of its own
(the empty name); rows with a null id keep all their lines; rows that share an id are treated as
one document; an empty table gives an empty table; other columns pass through, one named ``n_lines``
or ``n_removed`` as ``n_lines_input`` or ``n_removed_input``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityobs.llm.columns import unpacked, whole
from cityobs.scratch import materialise

#: Distinct sites that make a line boilerplate.
MIN_SITES = 5
#: Sketches keep 2 ** 12 slots: a standard error of 1.6 %.
SKETCH_BITS = 12
#: Estimates within this share of the threshold are counted exactly: over ten standard errors.
NEAR = 0.2
#: Line hashes (40 bytes each) that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 200_000


def line_key(line: Column) -> Column:
    """Two hashes with different seeds of the line without spaces around it."""
    bare = F.trim(line)
    return F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(F.lit("second"), bare).alias("b"))


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _few(df: DataFrame) -> DataFrame:
    """Broadcast only if the written rows are few."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``key`` and ``first_id`` of the boilerplate among rows of ``id``, ``site`` and ``key``."""
    spread = materialise(
        lines.groupBy("key")
        .agg(F.hll_sketch_agg("site", SKETCH_BITS).alias("sketch"), F.min("id").alias("first_id"))
        .select("key", "first_id", F.hll_sketch_estimate("sketch").alias("sites"))
        .where(F.col("sites") >= min_sites * (1 - NEAR)),
        "line-spread",
    )
    sure = spread.where(F.col("sites") > min_sites * (1 + NEAR)).select("key", "first_id")
    near = spread.where(F.col("sites") <= min_sites * (1 + NEAR)).select("key", "first_id")
    exact = (
        lines.select("key", "site")
        .join(_few(near.select("key")), "key")
        .distinct()
        .groupBy("key")
        .count()
        .where(F.col("count") >= min_sites)
        .select("key")
    )
    return materialise(sure.unionByName(near.join(exact, "key")), "boilerplate")


def remove_boilerplate(
    df: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    site: str = "source",
    min_sites: int = MIN_SITES,
) -> DataFrame:
    """``df`` with cleaned texts plus ``n_lines`` and ``n_removed``."""
    digest = F.xxhash64(F.col(text))
    each = df.select(
        F.col(id_col).alias("id"),
        digest.alias("digest"),
        F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"),
        F.posexplode(split_lines(F.col(text))).alias("pos", "line"),
    )
    lines = each.where(F.trim("line") != "").select("id", "digest", "site", "pos", line_key(F.col("line")).alias("key"))
    found = boilerplate(lines.select("id", "site", "key"), min_sites)
    drops = (
        lines.select("id", "digest", "pos", "key")
        .join(_few(found), "key")
        .where(F.col("id") != F.col("first_id"))
        .groupBy("id", "digest")
        .agg(F.collect_set("pos").alias("drops"))
    )
    own = whole(df, F.col(id_col).alias("row_id"), digest.alias("row_digest"))
    met = own.join(drops, (F.col("row_id") == F.col("id")) & (F.col("row_digest") == F.col("digest")), "left")
    joined = met.select("row", "drops", split_lines(F.col("row").getField(text)).alias("parts"))
    # The places left over are found with one hash set for each text, however many lines it has.
    kept = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("drops"))
    count = lambda lines: F.size(F.filter(lines, lambda x: F.trim(x) != "")).cast("long")
    left = F.array_join(F.transform(kept, lambda p: F.get(F.col("parts"), p)), "\n")
    cleaned = F.when(F.col("drops").isNull(), F.array_join("parts", "\n")).otherwise(left)
    added = ["n_lines", "n_removed"]
    return joined.select(
        *unpacked(df, added, {text: cleaned}),
        count(F.col("parts")).alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_removed"),
    )
