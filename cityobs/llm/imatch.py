"""I-Match fingerprints with several randomised lexicons.

The lexicon is the terms whose share of documents lies in a band: neither so common that they tell
nothing nor so rare that they may be typing errors. Every term is put at random, by its hash, into
some of the subsets of several levels; a level's subsets hold the same share of the lexicon, from
nine tenths of it to one in 2,048. A text's distinct terms of the lexicon are sorted, and for each
subset the sequence of those in it is hashed to 64 bits. Two texts that differ in a term still have
the hashes of all subsets without it. Fingerprints are alike by the largest share of equal hashes
on a level where a third of the subsets hold something: near copies agree on subsets of most of the
lexicon, and on sparse levels, where a subset holds a term or two of a text, the share falls
gradually with the terms that differ, for short texts and long ones.

Lower-cased are A to Z; terms are runs of anything but ASCII white space. Defined cases: a null
text is an empty one; a text without a term of the lexicon has only zeros and a digest of its whole
text, which is alike to equal texts (1) and to nothing else (0); of rows with one id the order is
that of their texts; null ids come first; with one row the next document is itself; an empty table
gives an empty table; only the id and the text are read. Ids that are no whole numbers have no next
document here and are a TypeError.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Band of document shares. Texts of 235 different terms in the mean have 235 / LEAST at most in it.
LEAST, MOST = 0.001, 0.1
#: Terms of 2,048 that are in a subset of each level, and subsets of a level.
SHARES, SUBSETS = (1843, 1024, 256, 64, 16, 4, 1), 20
#: Slots of the filter that decides which terms are counted exactly.
SLOTS = 1 << 20
#: Buckets of neighbouring ids for each shuffle partition, so that partitions come out even.
BUCKETS = 4


def terms(text: str | None) -> set[bytes]:
    return set((text or "").encode("utf-8", "surrogatepass").lower().split())


def _slot(term: bytes) -> int:
    return xxhash.xxh3_64_intdigest(term) & (SLOTS - 1)


def _document_counts(docs: DataFrame, text: str, keep) -> DataFrame:
    """Documents that hold a term, by task, for the terms that ``keep`` picks from a task's counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, numbers in keep(batches):
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(numbers, pa.int64())], names=["term", "n"])

    return docs.select(F.col(text)).mapInArrow(run, "term binary, n long")


def lexicon(docs: DataFrame, text: str = "text", least: float = LEAST, most: float = MOST) -> list[bytes]:
    """Terms of the band, sorted; document counts are exact and cover all documents.

    A term that a share ``least`` of all documents holds is held by as large a share of what one of
    the tasks reads. In a first pass each task counts slots of a fixed number and reports those that
    hold as much; a second pass counts, exactly and over all documents, the terms of those slots.
    """
    total = docs.count()
    needed = max(2, math.ceil(least * total))

    def frequent(batches):
        held, n = np.zeros(SLOTS, np.int64), 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                found = terms(t)
                np.add.at(held, np.fromiter(map(_slot, found), np.int64, len(found)), 1)
                n += 1
        slots = np.flatnonzero(held >= max(1, math.floor(least * n)))
        for start in range(0, len(slots), 50_000):
            some = slots[start : start + 50_000].tolist()
            yield [s.to_bytes(4, "big") for s in some], [1] * len(some)

    marked = np.zeros(SLOTS, bool)
    for row in _document_counts(docs, text, frequent).select("term").distinct().toLocalIterator():
        marked[int.from_bytes(row["term"], "big")] = True
    bits = np.packbits(marked).tobytes()

    def counted(batches):
        open_, seen, known = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool), Counter(), {}

        def out():
            found = {t: c for t, c in seen.items() if known[t]}
            return list(found), list(found.values())

        for batch in batches:
            for t in batch.column(0).to_pylist():
                seen.update(terms(t))
                if len(seen) > 400_000:
                    known = {t: bool(open_[_slot(t)]) for t in seen}
                    yield out()
                    seen, known = Counter(), {}
        known = {t: bool(open_[_slot(t)]) for t in seen}
        yield out()

    sums = _document_counts(docs, text, counted).groupBy("term").agg(F.sum("n").alias("n"))
    band = sums.where((F.col("n") >= needed) & (F.col("n") <= max(needed, most * total))).select("term").toArrow()
    return sorted(band.column("term").to_pylist())


@dataclass
class Fingerprints:
    """Fingerprints of texts by a lexicon."""

    lexicon: list[bytes]

    def __getstate__(self):
        return {"lexicon": self.lexicon}

    def prepare(self) -> Fingerprints:
        self.hashes = np.array([xxhash.xxh3_64_intdigest(t) for t in self.lexicon], np.uint64)
        #: Whether a subset (column) holds a term (row).
        self.member = np.zeros((len(self.hashes), len(SHARES) * SUBSETS), bool)
        for k in range(self.member.shape[1]):
            x = self.hashes ^ np.uint64(xxhash.xxh3_64_intdigest(b"%d" % k))
            x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            self.member[:, k] = (x >> np.uint64(32)) % np.uint64(2048) < SHARES[k // SUBSETS]
        self.index = {t: i for i, t in enumerate(self.lexicon)}
        return self

    def codes(self, found: set[bytes]) -> np.ndarray:
        """The hash of each subset's sequence of sorted terms; 0 if it holds no term of the text."""
        # The lexicon is sorted, so places in it are in the order of the terms.
        at = np.array(sorted([i for t in found if (i := self.index.get(t)) is not None]), np.int64)
        held = np.ascontiguousarray(self.member[at].T)
        sequences = memoryview(np.broadcast_to(self.hashes[at], held.shape)[held].astype("<u8", copy=False).tobytes())
        out, start, digest = [0] * len(held), 0, xxhash.xxh3_64_intdigest
        for k, end in enumerate((8 * held.sum(axis=1).cumsum()).tolist()):
            if end > start:
                out[k] = digest(sequences[start:end]) or 1
                start = end
        return np.array(out, np.uint64)

    def of(self, text: str) -> tuple[np.ndarray, str]:
        codes = self.codes(terms(text))
        name = codes.astype(">u8").tobytes().hex()
        if codes.any():
            return codes, name
        return codes, name + hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()[:16]


def likeness(a: tuple[np.ndarray, str], b: tuple[np.ndarray, str]) -> float:
    """Largest share of equal hashes on a level of which either text fills a third, or on the fullest."""
    if a[1] == b[1]:
        return 1.0
    either, equal = (a[0] != 0) | (b[0] != 0), (a[0] == b[0]) & (a[0] != 0)
    levels, same = either.reshape(-1, SUBSETS).sum(1), equal.reshape(-1, SUBSETS).sum(1)
    full = 3 * levels >= SUBSETS
    if not full.any():
        full = levels == levels.max()
    return float((same[full] / np.maximum(levels[full], 1)).max())


def fingerprint(df: DataFrame, words: list[bytes], text: str = "text", into: str = "fingerprint") -> DataFrame:
    """All columns of ``df`` plus the fingerprint of the text."""
    schema = T.StructType([*df.schema, T.StructField(into, T.StringType())])
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = Fingerprints(words).prepare()
        for batch in batches:
            done = [prints.of(t or "")[1] for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(done, pa.string())], names=schema.fieldNames())

    return df.mapInArrow(run, schema)


def _at_most(bounds: list[int], value: Column) -> Column:
    """How many of the ascending bounds are at most the value, by halving."""
    if not bounds:
        return F.lit(0)
    array = F.array(*map(F.lit, bounds))
    state = F.struct(F.lit(0).alias("a"), F.lit(len(bounds)).alias("b"))

    def step(s: Column, _: Column) -> Column:
        middle = F.call_function("div", s["a"] + s["b"], F.lit(2)).cast("int")
        below = (s["a"] < s["b"]) & (F.get(array, F.least(middle, F.lit(len(bounds) - 1))) <= value)
        return F.struct(
            F.when(below, middle + 1).otherwise(s["a"]).alias("a"),
            F.when(below | (s["a"] >= s["b"]), s["b"]).otherwise(middle).alias("b"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(len(bounds).bit_length())), state, step, lambda s: s["a"])


def with_next(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows in buckets of neighbouring ids, sorted; each bucket ends with a guest, the next one's first row.

    Texts are shuffled once. Columns: bucket, guest, id, text.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rank = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)).cast("long"))
    shares = [k / (BUCKETS * partitions) for k in range(1, BUCKETS * partitions)]
    found = docs.agg(F.percentile_approx(rank, F.array(*map(F.lit, shares)), 10 * BUCKETS * partitions)).first()[0]
    bounds = sorted(set(found or []))
    ranked = docs.select(rank.alias("rank"), F.col(id_col).alias("id"), F.col(text).alias("text"))
    placed = ranked.withColumn("bucket", _at_most(bounds, F.col("rank")).cast("int"))
    firsts = {r["bucket"]: r["first"] for r in placed.groupBy("bucket").agg(F.min("rank").alias("first")).collect()}
    order = sorted(firsts)
    before = {b: order[k - 1] for k, b in enumerate(order)}
    first = F.array(*[F.lit(firsts.get(b)).cast("long") for b in range(len(bounds) + 1)])
    guest_of = F.array(*[F.lit(before.get(b)).cast("int") for b in range(len(bounds) + 1)])
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest"))
    guest = F.struct(F.get(guest_of, F.col("bucket")).alias("bucket"), F.lit(True).alias("guest"))
    places = F.when(F.col("rank") == F.get(first, F.col("bucket")), F.array(own, guest)).otherwise(F.array(own))
    return (
        placed.withColumn("place", F.explode(places))
        .select("place.*", "rank", "id", "text")
        .repartition(partitions, "bucket")
        .sortWithinPartitions("bucket", "guest", "rank", "text")
        .select("bucket", "guest", "id", "text")
    )


def compare_edits(docs: DataFrame, words: list[bytes], id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text has, instead of its last quarter of code points, as many of the first ones of
    the next document by id; the last document is followed by the first.
    """
    if not isinstance(docs.schema[id_col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise TypeError(f"the ids of {id_col!r} are no whole numbers")
    rows = with_next(docs, id_col, text)
    kind = rows.schema["id"].dataType
    names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [kind, T.LongType(), *[T.StringType()] * 3, T.DoubleType(), T.DoubleType()]
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, types, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = Fingerprints(words).prepare()
        last = None  # bucket, id, text, fingerprint of the row that waits for its next
        for batch in batches:
            ids, out = [], [[] for _ in names[1:]]
            columns = [batch.column(k) for k in range(4)]
            for bucket, guest, i, t in zip(columns[0].to_pylist(), columns[1].to_pylist(), columns[2], columns[3].to_pylist(), strict=True):
                t = t or ""
                if last is not None and last[0] == bucket:
                    own, print_ = prints.of(t), last[3]
                    cut = len(last[2]) // 4
                    edited = last[2][: len(last[2]) - cut] + t[:cut]
                    changed = prints.of(edited)
                    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                    values = (len(last[2]), digest, print_[1], changed[1], likeness(print_, changed), likeness(print_, own))
                    ids.append(last[1])
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                    last = None if guest else (bucket, i, t, own)
                elif not guest:
                    last = (bucket, i, t, prints.of(t))
            if ids:
                kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                arrays = [pa.array(x, k) for x, k in zip(out, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([i.as_py() for i in ids], columns[2].type), *arrays], names=names)

    return rows.mapInArrow(run, schema)
