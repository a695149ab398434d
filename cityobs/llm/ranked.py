"""Ranked lexical search: accumulators for short lists, document-at-a-time skipping over long ones.

Documents are cut into blocks; each block gets an inverted index of the queries' terms with the
integer score that each posting adds. For one query in one block the short lists are added up term
at a time. Their sums are one more list, ordered by document and with a known highest value. It is
read together with the long lists document at a time: lists whose highest values cannot lift a
document above the k-th best score so far are not read through but only looked into, by skipping
to the candidates that the others bring, and a candidate goes as soon as the rest cannot lift it.

Queries are taken in blocks of bounded size; documents are read once for each block of queries to
keep the postings of its terms, which are written to the shared folder, and once more to be
searched. A block of documents gives at most k rows a query; those meet in two steps.

Defined cases: a null or empty text has no terms, is found by nothing and does not count as a
document; a query without terms finds nothing; a null id comes first among equal scores; repeated
documents and repeated queries are separate rows; an empty table of either gives an empty table.
Only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cityobs.scratch import materialise

#: Bytes of the texts of queries that are searched for together; a longer text is a block of its own.
QUERY_BYTES = 4_000_000
#: Postings and documents of a block; the last document may go beyond the first.
BLOCK_POSTINGS, BLOCK_DOCUMENTS = 2_000_000, 32_768
#: A list is short if it has at most one posting for so many documents of its block.
SHORT = 32
#: Documents that are looked at together: at first, and at most.
FIRST_SPAN, LAST_SPAN = 256, 8192
#: Tasks among which the rows of one query are dealt before they meet.
SALTS = 32


def _separators() -> bytes:
    """For ``bytes.translate``: A to Z lower-cased, all ASCII but letters and digits a space."""
    out = bytearray(b" " * 128) + bytes(range(128, 256))
    for low, high in ((b"0", b"9"), (b"A", b"Z"), (b"a", b"z")):
        for b in range(low[0], high[0] + 1):
            out[b] = b + 32 if low == b"A" else b
    return bytes(out)


SEPARATORS = _separators()


def counted(text: bytes | None) -> Counter[bytes]:
    """Occurrences of every term of a text in UTF-8."""
    out = Counter((text or b"").translate(SEPARATORS).split(b" "))
    out.pop(b"", None)
    return out


def _postings(docs: DataFrame, text: str, id_col: str, vocabulary: list[bytes]) -> DataFrame:
    """Id, number of terms with repeats, and the vocabulary's terms with their occurrences."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("n", T.LongType())])
    for name in ("terms", "counts"):
        schema.add(name, T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {t: i for i, t in enumerate(vocabulary)}
        for batch in batches:
            n, ends, found, times = [], [0], [], []
            for value in batch.column(1).cast(pa.large_binary()):
                own = counted(value.as_py())
                n.append(own.total())
                known = [(place[t], c) for t, c in own.items() if t in place]
                found += [i for i, _ in known]
                times += [c for _, c in known]
                ends.append(len(found))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (found, times)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), *lists], names=schema.fieldNames())

    return docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInArrow(run, schema)


def _frequencies(postings: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "n"])

    table = postings.select("terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[table.column("term").to_numpy()] = table.column("n").to_numpy()
    return out


@dataclass
class List:
    """Documents of a block in order, what each adds to the score, and the most that one adds."""

    docs: np.ndarray
    adds: np.ndarray
    most: int = field(init=False)
    at: int = field(init=False, default=0)

    def __post_init__(self):
        self.most = int(self.adds.max(initial=0))

    def until(self, end: int) -> slice:
        """The part from where it stands to the document ``end``, beyond which it then stands."""
        to = self.at + int(np.searchsorted(self.docs[self.at :], end))
        part, self.at = slice(self.at, to), to
        return part

    def skip(self, start: int) -> None:
        self.at += int(np.searchsorted(self.docs[self.at :], start))

    def of(self, docs: np.ndarray) -> np.ndarray:
        """What it adds to each of these documents."""
        at = np.searchsorted(self.docs, docs)
        at[at == len(self.docs)] = 0
        return np.where(self.docs[at] == docs, self.adds[at], 0) if len(self.docs) else np.zeros(len(docs), np.int64)


def accumulate(lists: list[List]) -> List:
    """The sum of several lists, term at a time, as one list."""
    docs = np.concatenate([x.docs for x in lists])
    order = np.argsort(docs, kind="stable")
    docs, adds = docs[order], np.concatenate([x.adds for x in lists])[order]
    begins = np.flatnonzero(np.diff(docs, prepend=-1))
    return List(docs[begins], np.add.reduceat(adds, begins) if len(begins) else adds)


def best(lists: list[List], n_docs: int, k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The k documents of the highest scores above ``floor``, equal scores by document.

    Lists are read through in the order of documents, so an equal score never displaces an earlier
    one, and only scores above the threshold matter.
    """
    short = [x for x in lists if len(x.docs) * SHORT <= n_docs]
    lists = [x for x in lists if len(x.docs) * SHORT > n_docs]
    if short:
        lists.append(accumulate(short))
    lists = sorted((x for x in lists if x.most > 0), key=lambda x: x.most)
    bounds = np.cumsum([x.most for x in lists])  # of the lists up to this one
    top_docs, top_scores, threshold = np.zeros(0, np.int64), np.zeros(0, np.int64), floor
    start, span = 0, FIRST_SPAN
    while start < n_docs:
        looked = int(np.searchsorted(bounds, threshold, "right"))  # these alone lift nothing above it
        read = lists[looked:]
        for x in read:
            x.skip(start)
        ahead = [int(x.docs[x.at]) for x in read if x.at < len(x.docs)]
        if not ahead:
            break
        start = min(ahead)
        end = min(start + span, n_docs)
        sums = np.zeros(end - start, np.int64)
        for x in read:
            part = x.until(end)
            sums[x.docs[part] - start] += x.adds[part]
        docs = np.flatnonzero(sums)
        scores = sums[docs]
        docs = docs + start
        for j in range(looked - 1, -1, -1):
            left = scores + bounds[j] > threshold
            docs, scores = docs[left], scores[left]
            if not len(docs):
                break
            scores = scores + lists[j].of(docs)
        left = scores > threshold
        if left.any():
            top_docs, top_scores = np.concatenate([top_docs, docs[left]]), np.concatenate([top_scores, scores[left]])
            order = np.lexsort((top_docs, -top_scores))[:k]
            top_docs, top_scores = top_docs[order], top_scores[order]
            if len(top_docs) == k:
                threshold = max(floor, int(top_scores[-1]))
        start, span = end, min(2 * span, LAST_SPAN)
    return top_docs, top_scores


@dataclass
class Block:
    """An inverted index of some documents, in the order of their ids."""

    ids: pa.Array
    bounds: np.ndarray
    docs: np.ndarray
    adds: np.ndarray

    @classmethod
    def of(cls, batches: list[pa.RecordBatch], weights: np.ndarray, documents: int, length: int) -> Block:
        table = pa.Table.from_batches(batches).combine_chunks()
        order = pc.sort_indices(table, sort_keys=[("id", "ascending")], null_placement="at_start")
        table = table.take(order).combine_chunks()
        lists = table.column("terms").combine_chunks()
        n = table.column("n").to_numpy()
        sizes = lists.value_lengths().to_numpy()
        docs = np.repeat(np.arange(len(n)), sizes)
        found = lists.flatten().to_numpy()
        times = table.column("counts").combine_chunks().flatten().to_numpy().astype(np.int64)
        spread = 100 - 75 + (75 * n * documents) // length
        adds = weights[found] * ((1_000_000_000 * times) // (1000 * times + 8 * spread[docs]))
        by_term = np.argsort(found, kind="stable")
        bounds = np.searchsorted(found[by_term], np.arange(len(weights) + 1))
        return cls(table.column("id").combine_chunks(), bounds, docs[by_term], adds[by_term])

    def lists(self, query: list[tuple[int, int]]) -> list[List]:
        """One for each term of the query; ``query`` has terms and how often each stands there."""
        cuts = [(slice(self.bounds[t], self.bounds[t + 1]), times) for t, times in query]
        return [List(self.docs[c], self.adds[c] * times) for c, times in cuts if c.start < c.stop]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    waiting, size, rows = [], 0, 0
    for batch in batches:
        waiting.append(batch)
        size += len(batch.column(2).flatten())
        rows += batch.num_rows
        if size > BLOCK_POSTINGS or rows > BLOCK_DOCUMENTS:
            yield waiting
            waiting, size, rows = [], 0, 0
    if waiting:
        yield waiting


def _weights(frequencies: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in frequencies.tolist()], np.int64)


def _search(postings: DataFrame, queries: list[tuple[int, Counter[bytes]]], vocabulary: list[bytes], k: int) -> DataFrame:
    """Query number, id and score of the best documents of every block."""
    documents, length = postings.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    schema = T.StructType([T.StructField("query", T.LongType()), postings.schema["id"], T.StructField("score", T.LongType())])
    if not documents:
        return postings.sparkSession.createDataFrame([], schema)
    weights = _weights(_frequencies(postings, len(vocabulary)), documents)
    place = {t: i for i, t in enumerate(vocabulary)}
    asked = [(number, [(place[t], times) for t, times in own.items()]) for number, own in queries]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floors = dict.fromkeys((number for number, _ in asked), 0)
        for some in _blocks(batches):
            block = Block.of(some, weights, documents, length)
            numbers, places, scores = [], [], []
            for number, query in asked:
                # A later block may hold an equal score with a smaller id, so the floor is one below.
                docs, found = best(block.lists(query), len(block.ids), k, floors[number])
                if len(docs) == k:
                    floors[number] = max(floors[number], int(found[-1]) - 1)
                numbers.append(np.full(len(docs), number, np.int64))
                places.append(docs)
                scores.append(found)
            ids = block.ids.take(pa.array(np.concatenate(places)))
            columns = [pa.array(np.concatenate(numbers)), ids, pa.array(np.concatenate(scores))]
            yield pa.RecordBatch.from_arrays(columns, names=["query", "id", "score"])

    return postings.mapInArrow(run, schema)


def _top(found: DataFrame, k: int, *group: str | Column) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_first("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _query_blocks(queries: DataFrame, text: str) -> list[DataFrame]:
    """Queries in blocks whose texts have ``QUERY_BYTES`` together, or that are one query each."""
    size, longest = queries.agg(F.sum(F.octet_length(text)), F.max(F.octet_length(text))).first()
    parts = max(1, -(-2 * (size or 0) // QUERY_BYTES))
    if parts == 1:
        return [queries]
    block = F.pmod(F.xxhash64("query"), F.lit(parts))
    while True:
        sizes = queries.groupBy(block.alias("b")).agg(F.sum(F.octet_length(text)).alias("s"), F.count("*").alias("n")).collect()
        if all(r["s"] is None or r["s"] <= max(QUERY_BYTES, longest or 0) or r["n"] == 1 for r in sizes):
            return [queries.where(block == r["b"]) for r in sizes]
        parts *= 2
        block = F.pmod(F.xxhash64("query"), F.lit(parts))


def search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 10,
    text: str = "text",
    id_col: str = "doc_id",
    query_text: str = "text",
    query_id: str = "item_id",
) -> DataFrame:
    """The ``k`` documents of the highest score above 0 for every query: its id, rank, document id, score."""
    if query_id == id_col:
        raise ValueError("the ids of queries and documents need different names")
    numbered = queries.select(F.col(query_id).alias("name"), F.col(query_text).alias("text"))
    numbered = materialise(numbered.withColumn("query", F.monotonically_increasing_id()), "queries")
    found = None
    for some in _query_blocks(numbered, "text"):
        asked = [(r["query"], own) for r in some.select("query", "text").collect() if (own := counted((r["text"] or "").encode()))]
        if not asked:
            continue
        vocabulary = sorted(set().union(*(own for _, own in asked)))
        postings = materialise(_postings(docs, text, id_col, vocabulary), "postings")
        part = _search(postings, asked, vocabulary, k)
        found = part if found is None else found.unionByName(part)
    if found is None:
        schema = T.StructType([T.StructField("query", T.LongType()), T.StructField("id", docs.schema[id_col].dataType)])
        found = docs.sparkSession.createDataFrame([], schema.add("score", T.LongType()))
    salted = found.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    top = _top(_top(salted, k, "query", "salt").drop("rank"), k, "query")
    names = numbered.select("query", "name")
    return top.join(names, "query").select(
        F.col("name").alias(query_id), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score"
    )
