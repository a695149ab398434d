"""A bounded sample of labelled texts, brought to the driver to fit a classifier."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Labelled texts that a classifier is fitted on, at most.
MAX_TEXTS = 4_000
#: Characters of these texts together, at most; whole texts are taken, those that do not fit are passed over.
MAX_CHARS = 12_000_000
#: Texts of more characters come after all others, so that a few of them do not take the place of many.
LONG_CHARS = 120_000


def fold(doc_id: Column, folds: int) -> Column:
    """Remainder of the checksum of the id as text. A null id counts as an empty one."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds)).cast("int")


def sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    usable: Column,
    id_col: str = "doc_id",
    text: str = "text",
    max_texts: int = MAX_TEXTS,
    max_chars: int = MAX_CHARS,
    long_chars: int = LONG_CHARS,
) -> list[tuple[str, int]]:
    """Whole texts and 0/1 labels, in the order of a hash of their ids.

    The first ``max_texts`` labels by hash are taken, so their side of the join is bounded and can
    be broadcast: no text is shuffled. Null ids, null labels and labels other than 0 and 1 are left
    out; an id with several labels takes its largest; of repeated rows of an id all are taken that
    fit. A text that would take the sample past ``max_chars`` is passed over and the next ones are
    tried; texts of more than ``long_chars`` are tried after all others, in the same order.
    """
    order = F.xxhash64(F.col(id_col).cast("string"))
    chosen = (
        labels.select(F.col(id_col), F.col(label).cast("int").alias("__label"))
        .where(F.col(id_col).isNotNull() & F.col("__label").isin(0, 1) & usable)
        .groupBy(id_col)
        .agg(F.max("__label").alias("__label"))
        .orderBy(order, id_col)
        .limit(max_texts)
    )
    found = docs.select(F.col(id_col), F.coalesce(F.col(text), F.lit("")).alias("__text")).join(
        F.broadcast(chosen), id_col
    )
    sized = found.select(id_col, "__label", F.length("__text").alias("__chars"))
    tried = sized.orderBy(order, id_col, "__chars").limit(max_texts).collect()
    kept, chars = Counter(), 0
    for row in sorted(tried, key=lambda r: r["__chars"] > long_chars):
        if chars + row["__chars"] <= max_chars:
            chars += row["__chars"]
            kept[row[id_col], row["__chars"]] += 1
    if not kept:
        return []
    schema = chosen.select(id_col, F.lit(0).alias("__chars"), F.lit(0).alias("__n")).schema
    wanted = chosen.sparkSession.createDataFrame([(*key, n) for key, n in kept.items()], schema)
    # Of rows of one id and one length no more are brought than were counted.
    at = F.row_number().over(Window.partitionBy(id_col, "__chars").orderBy("__text"))
    met = found.withColumn("__chars", F.length("__text")).join(F.broadcast(wanted), [id_col, "__chars"])
    rows = met.withColumn("__at", at).where(F.col("__at") <= F.col("__n")).select(id_col, "__text", "__label").collect()
    rows.sort(key=lambda r: (str(r[id_col]), r["__text"]))
    return [(r["__text"], r["__label"]) for r in rows[:max_texts]]
