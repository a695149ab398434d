"""Document likelihood over all segmentations of every word into pieces of an existing vocabulary.

The vocabulary is a SentencePiece file; nothing is added to it. A piece's probability follows how
often the vocabulary's own segmentation of the training words uses it, on top of what its score
says; pieces that it never uses there keep the little weight of their score. A word's probability is the sum over all its segmentations (forward recursion in log space),
mixed with the word's own discounted share among the training tokens, as a piece that spells all of
it would have; the mass taken from seen words is what unseen ones share. A document is its words
and one end. Words that make up a millionth of the tokens or more (a million at most) are scored
where the documents are; the others meet their scores by a shuffle on the word.

Lower-cased are A to Z; words are runs of anything but ASCII white space. Defined cases: a null or
empty text is its end alone; without training documents every token is as rare as one never seen;
equal rows get equal scores and stay apart; a null id counts as an empty one for the fold; an empty
table gives an empty table; only the id and the text are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityobs.scratch import materialise

#: Share of the training tokens from which a word is scored where the documents are.
COMMON = 1e-6
#: What each seen word gives to the unseen ones.
DISCOUNT = 0.7
#: Pseudo-count of the base score.
BASE = 0.1
#: Different words that a task counts before it hands them on.
COUNTED = 300_000
#: The end of a document; no word holds white space.
END = b"\n"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


@lru_cache(maxsize=2)
def _processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def counts(docs: DataFrame, training: Column, text: str = "text") -> DataFrame:
    """``word`` and its count ``c`` among training documents, for the words of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, other = Counter(), set()

        def out():
            other.difference_update(seen)
            names = [*seen, *other]
            numbers = [*seen.values(), *([0] * len(other))]
            batch = pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(numbers, pa.int64())], names=["word", "c"])
            seen.clear()
            other.clear()
            for start in range(0, batch.num_rows, 50_000):
                yield batch.slice(start, 50_000)

        for batch in batches:
            for t, trains in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = words(t)
                found.append(END)
                if trains:
                    seen.update(found)
                else:
                    other.update(found)
                if len(seen) + len(other) > COUNTED:
                    yield from out()
        yield from out()

    each = docs.select(F.col(text), training).mapInArrow(run, "word binary, c long")
    return each.groupBy("word").agg(F.sum("c").alias("c"))


def piece_counts(counted: DataFrame, vocabulary: str) -> dict[int, int]:
    """How often the vocabulary's own segmentation of the different training words uses each piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = _processor(vocabulary)
        found = np.zeros(processor.get_piece_size(), np.int64)
        for batch in batches:
            some = [w.decode(errors="replace") for w in batch.column(0).to_pylist()]
            for start in range(0, len(some), 10_000):
                ids = processor.encode(some[start : start + 10_000], num_threads=1)
                flat = np.fromiter((i for x in ids for i in x), np.int64)
                found += np.bincount(flat, minlength=len(found))
        used = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(found[used])], names=["piece", "n"])

    used = counted.where((F.col("c") > 0) & (F.col("word") != F.lit(END))).select("word").mapInArrow(run, "piece long, n long")
    return {r["piece"]: r["n"] for r in used.groupBy("piece").agg(F.sum("n").alias("n")).collect()}


class Pieces:
    """Natural logarithms of piece probabilities, which sum to one, and a word's likelihood."""

    def __init__(self, vocabulary: str, used: dict[int, int]):
        processor = _processor(vocabulary)
        self.bytes: dict[int, float] = {}
        weights: dict[str, float] = {}
        byte_weight = np.full(256, 1e-3)
        for i in range(processor.get_piece_size()):
            if processor.is_byte(i):
                byte_weight[int(processor.id_to_piece(i)[3:5], 16)] += used.get(i, 0)
            elif not (processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i)):
                # The vocabulary's scores are ranks; alone they give a piece little weight.
                prior = 1.0 / (10.0 - min(processor.get_score(i), 0.0))
                piece = processor.id_to_piece(i)
                weights[piece] = weights.get(piece, 0.0) + used.get(i, 0) + prior
        total = sum(weights.values()) + float(byte_weight.sum())
        self.log = {p: math.log(w / total) for p, w in weights.items()}
        self.byte_log = np.log(byte_weight / total).tolist()
        self.longest = max(map(len, weights), default=1)

    def likelihood(self, word: bytes) -> float:
        """Natural logarithm of the sum over all segmentations of the word after its boundary mark."""
        return self._forward("▁" + word.decode(errors="replace"))

    def _forward(self, text: str) -> float:
        # Sums are logarithms, and only those that a piece can still reach are kept, so that no word is too long.
        n, log, longest, byte_log = len(text), self.log, self.longest, self.byte_log
        size = min(n, longest) + 1
        reach = [-math.inf] * size
        reach[0] = 0.0
        exp, log1p = math.exp, math.log1p
        for i in range(n):
            at = i % size
            here, reach[at] = reach[at], -math.inf
            if here == -math.inf:
                continue
            stop = min(n, i + longest)
            for j in range(i + 1, stop + 1):
                step = log.get(text[i:j])
                if step is None:
                    if j > i + 1:
                        continue
                    step = sum(byte_log[b] for b in text[i].encode("utf-8", "surrogatepass"))
                step += here
                to = j % size
                other = reach[to]
                if step > other:
                    reach[to] = step + log1p(exp(other - step)) if other != -math.inf else step
                else:
                    reach[to] = other + log1p(exp(step - other))
        return reach[n % size]


def score_words(counted: DataFrame, pieces: Pieces, total: int, distinct: int) -> DataFrame:
    """``word``, ``c``, and the common logarithms ``base`` and ``score`` of its probabilities."""
    spare = DISCOUNT * distinct / total if total else 1.0
    end = 1 / (distinct + 2)
    floor = total + BASE * (distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, numbers = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            base = [math.log10((c + BASE) / floor) for c in numbers]
            scores = []
            for w, c in zip(names, numbers, strict=True):
                own = (c - DISCOUNT) / total if c else 0.0
                if w == END:  # spelled by no pieces
                    scores.append(math.log10(own + spare * end))
                    continue
                spelled = math.log(spare * (1 - end)) + pieces.likelihood(w)
                scores.append((math.log(own) + math.log1p(math.exp(spelled - math.log(own))) if own else spelled) / math.log(10))
            out = [*batch.columns, pa.array(base, pa.float64()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(out, names=["word", "c", "base", "score"])

    return counted.select("word", "c").mapInArrow(run, "word binary, c long, base double, score double")


def _document_rows(docs: DataFrame, common: dict[bytes, tuple[bool, float, float]], text: str) -> DataFrame:
    """One row for each document, with what its common words give, and one for each other word of it."""
    shared = docs.sparkSession.sparkContext.broadcast(common)
    names = ["id", "h", "word", "n", "copies", "tokens", "known", "base", "score"]
    types = [None, pa.int64(), pa.binary(), *([pa.int64()] * 4), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.value.get
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            at: list[int] = []

            def out():
                ids = batch.column(0).take(pa.array(at, pa.int64()))
                columns = [pa.array(x, t) for x, t in zip(rows[1:], types[1:], strict=True)]
                return pa.RecordBatch.from_arrays([ids, *columns], names=names)

            for k, (h, t) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                found = words(t)
                tokens, known, base, score = len(found) + 1, 0, 0.0, 0.0
                found.append(END)
                for w, n in Counter(found).items():
                    got = get(w)
                    if got is None:
                        at.append(k)
                        for column, value in zip(rows[1:], (h, w, n, 0, 0, 0, 0.0, 0.0), strict=True):
                            column.append(value)
                    else:
                        known += n if got[0] else 0
                        base += n * got[1]
                        score += n * got[2]
                at.append(k)
                # No word holds white space, so this one joins with nothing, and no two rows share a task for it.
                for column, value in zip(rows[1:], (h, b" %d" % (h or 0), 1, 1, tokens, known, base, score), strict=True):
                    column.append(value)
                if len(at) > 100_000:
                    yield out()
                    rows, at = [[] for _ in names], []
            if at:
                yield out()

    kind = docs.schema["id"].dataType.simpleString()
    schema = f"id {kind}, h long, word binary, n long, copies long, tokens long, known long, base double, score double"
    return docs.select("id", "h", F.col(text)).mapInArrow(run, schema)


def score(docs: DataFrame, training: Column, vocabulary: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every row."""
    counted = materialise(counts(docs, training, text), "word-counts")
    sums = counted.agg(F.sum("c").alias("total"), F.count(F.when(F.col("c") > 0, 1)).alias("distinct")).first()
    total, distinct = sums["total"] or 0, sums["distinct"]
    scored = materialise(score_words(counted, Pieces(vocabulary, piece_counts(counted, vocabulary)), total, distinct), "word-scores")
    # At most 1 / COMMON words, as their shares add up to one.
    rows = scored.where((F.col("c") >= max(1, math.ceil(COMMON * total))) | (F.col("word") == F.lit(END))).toArrow()
    common = {
        w: (c > 0, b, s)
        for w, c, b, s in zip(*(rows.column(n).to_pylist() for n in ("word", "c", "base", "score")), strict=True)
    }
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text)).alias("h"), F.col(text))
    each = _document_rows(keyed, common, text)
    rare = scored.where((F.col("c") < max(1, math.ceil(COMMON * total))) & (F.col("word") != F.lit(END))).select(
        "word", (F.col("c") > 0).cast("long").alias("seen"), F.col("base").alias("b"), F.col("score").alias("s")
    )
    n = F.col("n")
    met = each.join(rare, "word", "left").select(
        "id",
        "h",
        "copies",
        "tokens",
        (F.col("known") + n * F.coalesce("seen", F.lit(0))).alias("known"),
        (F.col("base") + n * F.coalesce("b", F.lit(0.0))).alias("base"),
        (F.col("score") + n * F.coalesce("s", F.lit(0.0))).alias("score"),
    )
    names = ("tokens", "known", "base", "score")
    whole = met.groupBy("id", "h").agg(F.sum("copies").alias("copies"), *(F.sum(c).alias(c) for c in names))
    copies = F.col("copies")
    return whole.select(
        F.col("id").alias(id_col),
        F.call_function("div", F.col("tokens"), copies).alias("n_tokens"),
        F.call_function("div", F.col("known"), copies).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") / copies).alias("base_score"),
        (F.col("score") / copies).alias("score"),
        F.explode(F.sequence(F.lit(1), copies.cast("int"))).alias("__copy"),
    ).drop("__copy")
