"""Target-distribution importance resampling over hashed n-grams.

Every document is weighted by how much likelier its n-grams are in a target corpus than in the
documents themselves. N-grams are runs of 1 to ``ORDER`` words, counted in ``BUCKETS`` buckets by
the checksum of their bytes. Weights plus Gumbel noise drawn from the document's id rank the
documents; the highest are a draw without replacement, the same in every run.

The corpus is read twice: once for the counts, of which each task adds up its own before the
shuffle, and once for the weights. What the driver holds is one number for each bucket. The scored
table has no texts unless they are asked for; only its upper part is sorted, by ranges of scores.

Defined cases: a null or empty text has no words, weight 0 and is never drawn; a null id draws its
noise from the empty string and comes first among equal scores; repeated rows count and are ranked
one by one; an empty target or corpus has counts of 0; an empty table gives an empty table. Only
the named columns are read, so other columns may have any name; a kept column may not have the
name of a result column, which is an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cityobs.llm.crc import span_crc32
from cityobs.scratch import materialise

BUCKETS, ORDER, LEAST_WORDS = 10_000, 3, 20
#: Bytes of text that are split into words at once, unless one text has more.
AT_ONCE = 1 << 21
RESULTS = ("n_words", "n_features", "weight", "score", "rank")


def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    """Every byte with A to Z lower-cased, and whether it belongs to a word: 0-9, a-z, or no ASCII."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    word = (lower >= 128) | ((lower >= 48) & (lower <= 57)) | ((lower >= 97) & (lower <= 122))
    return lower, word


LOWER, IS_WORD = _byte_tables()


@dataclass
class Words:
    """Words of several texts, written one after the other with one byte between them."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    #: Where each text's words begin; one more than texts.
    bounds: np.ndarray


def words_of(raw: np.ndarray, cuts: np.ndarray) -> Words:
    """``raw``: the texts' bytes; ``cuts``: where each text begins, and where the last ends."""
    lowered = LOWER[raw]
    inside = IS_WORD[raw]
    before = np.concatenate([[False], inside[:-1]]) if len(raw) else inside
    after = np.concatenate([inside[1:], [False]]) if len(raw) else inside
    edges = cuts[(cuts > 0) & (cuts < len(raw))]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    lengths = np.flatnonzero(inside & ~after) + 1 - starts
    begins = np.cumsum(lengths + 1) - lengths - 1
    data = np.full(int((lengths + 1).sum()), 32, np.uint8)
    data[np.arange(int(lengths.sum())) + np.repeat(np.arange(len(starts)), lengths)] = lowered[inside]
    return Words(data, begins, begins + lengths, np.searchsorted(starts, cuts))


def features(words: Words, order: int = ORDER) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of n-grams: their checksums text by text, and where each text's begin."""
    counts = np.diff(words.bounds)
    text = np.repeat(np.arange(len(counts)), counts)
    for n in range(1, order + 1):
        first = np.arange(max(0, len(text) - n + 1))
        first = first[text[first] == text[first + n - 1]]
        own = np.maximum(counts - n + 1, 0)
        yield span_crc32(words.data, words.starts[first], words.ends[first + n - 1]), np.concatenate([[0], np.cumsum(own)])


def _texts(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Some texts at a time: the place of the first, their bytes, and where each begins."""
    column = column.cast(pa.large_binary())
    column = column.fill_null(b"") if column.null_count else column
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + AT_ONCE, "right")) - 1)
        yield first, raw[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """N-grams of all documents in each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, raw, cuts in _texts(batch.column(0)):
                for sums, _ in features(words_of(raw, cuts)):
                    total += np.bincount(sums % np.uint32(buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    found = docs.select(F.col(text).alias("text")).mapInArrow(run, "bucket long, n long")
    table = found.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log of each bucket's share in the target over that in the corpus, rounded down."""
    size = len(corpus)
    s_all, t_all = float(corpus.sum() + size), float(target.sum() + size)
    ratios = [(float(t) + 1) * s_all / ((float(s) + 1) * t_all) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(x)) for x in ratios], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` plus ``n_words``, ``n_features`` and ``weight`` of every document."""
    if clash := sorted(set(keep) & set(RESULTS)):
        raise ValueError(f"kept columns have names of result columns: {', '.join(clash)}")
    kept = docs.select(*[docs[c] for c in keep])
    schema = T.StructType([*kept.schema, *[T.StructField(c, T.LongType()) for c in RESULTS[:3]]])
    width, buckets = len(keep), len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = [np.zeros(batch.num_rows, np.int64) for _ in range(3)]
            for first, raw, cuts in _texts(batch.column(width)):
                at = slice(first, first + len(cuts) - 1)
                words = words_of(raw, cuts)
                numbers[0][at] = np.diff(words.bounds)
                for sums, bounds in features(words):
                    numbers[1][at] += np.diff(bounds)
                    run_of = np.concatenate([[0], np.cumsum(gain[sums % np.uint32(buckets)])])
                    numbers[2][at] += run_of[bounds[1:]] - run_of[bounds[:-1]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *map(pa.array, numbers)], names=schema.fieldNames())

    return docs.select(*[docs[c] for c in keep], docs[text].alias("__text")).mapInArrow(run, schema)


def noise(id_col: str, seed: int) -> Column:
    """1000 times a Gumbel number drawn from the id, rounded down."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    share = (F.conv(F.substring(drawn, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(share))).cast("long")


def draw(weighed: DataFrame, percent: int, seed: int, id_col: str = "doc_id", least_words: int = LEAST_WORDS) -> DataFrame:
    """All columns plus ``score`` and ``rank``: the place among the drawn, null for the others.

    Drawn are ``percent`` of the documents that have ``least_words``. Only documents above a cut
    that at least as many reach are sorted, dealt to tasks by ranges of their scores.
    """
    scored = materialise(weighed.withColumn("score", F.col("weight") + noise(id_col, seed)), "scored")
    fits = F.col("n_words") >= least_words
    total, cut = scored.where(fits).agg(F.count("*"), F.percentile_approx("score", max(0.0, 1 - (percent + 1) / 100))).first()
    take = percent * total // 100
    high = fits & (F.col("score") >= (cut if cut is not None else 0))
    if scored.where(high).count() < take:  # the cut is an approximate one
        high = fits
    order = [F.desc("score"), F.asc_nulls_first(id_col)]
    upper = scored.where(high).repartitionByRange(*order).withColumn("__range", F.spark_partition_id())
    upper = materialise(upper, "ranges")
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each task
    before = upper.groupBy("__range").count().select("__range", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("__before"))
    place = F.col("__before") + F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    ranked = upper.join(before, "__range").withColumn("rank", place.cast("long")).select(*scored.columns, "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= take, F.col("rank")))
    return ranked.unionByName(scored.where(~high).withColumn("rank", F.lit(None).cast("long")))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int,
    seed: int = 42,
    text: str = "text",
    id_col: str = "doc_id",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """The id, ``keep``, and each document's counts, weight, score and rank among the drawn."""
    gain = gains(bucket_counts(docs, text), bucket_counts(target, text))
    return draw(weigh(docs, gain, text, (id_col, *keep)), percent, seed, id_col)
