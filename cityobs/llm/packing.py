"""Packing of tokenised documents into few sequences of a fixed length, by bin completion.

A document's ids are cut into pieces of at most ``capacity``; pieces are packed whole. What packing
needs to know of them are their lengths, and there are at most ``capacity`` different ones: Spark
counts the pieces of each length, the plan is made of these counts alone, whatever the number of
pieces, and Spark gives every piece its place from its rank among those of its length.

The plan is a list of fillings, each with the number of sequences that get it. Best-fit decreasing
gives the first one. Branch and bound looks for fewer sequences: it takes the largest length that
is left, enumerates the fillings around it that no other filling dominates, fullest first, uses each as
often as the counts allow and also once, and gives up a branch whose waste so far leaves no way
below the best plan known. It ends when a plan meets the lower bound, or after ``NODES`` fillings.

A filling is dominated by another if its pieces can be put into as many places as the other has
pieces, of their sizes; then the other leaves pieces that are no harder to pack. Tested are none to
three of its pieces against one larger piece that is left.

Defined cases: a null or empty text is its end id alone; repeated rows are pieces of their own; a
length below 1 or above the capacity is an error; an empty table gives an empty table. ``pack``
passes other columns through, whatever their names, but for those of its results, which are an error.
"""

from __future__ import annotations

import os
import struct
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cityobs.llm.bpe import byte_table
from cityobs.scratch import materialise

CAPACITY = 4096
#: Fillings that the search tries before it keeps the best plan so far.
NODES = 2_000
#: Fillings tried around one piece in one place of the search.
TRIED = 12
#: Pieces of one length that are ranked in one task, about.
RANKED = 100_000
#: Space-separated parts whose ids a Python worker remembers, twice; longer parts are not remembered.
REMEMBERED, LONGEST = 400_000, 100
#: Ids of an Arrow batch, about.
IDS_OUT = 500_000

Filling = tuple[tuple[int, int], ...]  # lengths, descending, and how often each


# --- the plan, from the counts of lengths


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences that any plan needs; ``counts`` has the pieces of each length.

    For every k up to half the capacity: pieces over ``capacity - k`` share with none of k or more;
    those over half share with no other; what those from k on have too much for their room needs more.
    """
    lengths = np.arange(capacity + 1)
    number, size = np.cumsum(counts), np.cumsum(counts * lengths)
    k, half = np.arange(capacity // 2 + 1), capacity // 2
    alone = number[-1] - number[half]  # both the large and those over half
    room = (number[capacity - k] - number[half]) * capacity - (size[capacity - k] - size[half])
    small = size[half] - np.where(k > 0, size[np.maximum(k - 1, 0)], 0)
    return int(max(-(-size[-1] // capacity), (alone + np.maximum(0, -(-(small - room) // capacity))).max()))


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing: every piece into the fullest sequence that takes it; equal ones at once."""
    groups: dict[int, list[tuple[Filling, int]]] = {capacity: []}  # by the room that is left
    rooms: list[int] = []

    def put(room: int, filling: Filling, times: int) -> None:
        if room not in groups:
            groups[room] = []
        if not groups[room]:
            insort(rooms, room)
        groups[room].append((filling, times))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                filling, times = groups[room].pop()
                if not groups[room]:
                    del rooms[at]
            else:
                room, filling, times = capacity, (), left
            each = min(room // length, left)
            full = min(times, left // each)
            if full < times and filling:
                put(room, filling, times - full)
            put(room - each * length, (*filling, (length, each)), full)
            left -= full * each
    return [x for room in rooms for x in groups[room]]


def _dominated(filling: dict[int, int], left: list[int], room: int) -> bool:
    """Whether none to three pieces can give way to one larger piece that is left, within the room."""
    parts = [n for n, k in filling.items() for _ in range(min(k, 3))][:12]
    for size in range(4):
        for some in set(combinations(parts, size)):
            total = sum(some)
            at = bisect_left(left, total + (size == 1))
            if at < len(left) and left[at] - total <= room:
                return True
    return False


def fillings(counts: np.ndarray, capacity: int, tried: int = TRIED) -> list[Filling]:
    """Undominated fillings around the largest piece, fullest first: ``tried`` of twice as many looked at."""
    first = int(np.flatnonzero(counts)[-1])
    room = capacity - first
    left = counts.copy()
    left[first] -= 1
    small = np.flatnonzero(left[: room + 1])
    if not len(small):
        return [((first, 1),)]
    if small[-1] == room:  # one piece that fills the room dominates all others
        return [((first, 2),) if room == first else ((first, 1), (room, 1))]
    lengths = small[::-1].tolist()
    falling = [-n for n in lengths]
    looked: dict[Filling, int] = {}

    def look(chosen: dict[int, int]) -> None:
        looked[tuple(sorted(chosen.items(), reverse=True))] = room - sum(n * k for n, k in chosen.items())

    partner = np.searchsorted(small, room - small, "right") - 1
    pairs = np.where(partner >= 0, small + small[partner], 0)
    for at in np.argsort(-pairs, kind="stable")[:tried].tolist():
        a, b = int(small[at]), int(small[partner[at]])
        if partner[at] >= 0 and (a != b or left[a] > 1):
            look({a: 1, b: 1} if a != b else {a: 2})

    def extend(at: int, space: int, chosen: dict[int, int]) -> None:
        at = max(at, bisect_left(falling, -space))
        if at == len(lengths):
            look(chosen)
        for j in range(at, len(lengths)):
            for k in range(min(space // lengths[j], int(left[lengths[j]])), 0, -1):
                if len(looked) >= 2 * tried:
                    return
                extend(j + 1, space - k * lengths[j], chosen | {lengths[j]: k})

    extend(0, room, {})
    found = []
    for filling, space in sorted(looked.items(), key=lambda x: (x[1], -x[0][0][0])):
        chosen = dict(filling)
        others = [int(n) for n in small if left[n] > chosen.get(n, 0)]
        if not _dominated(chosen, others, space):
            both = chosen | {first: chosen.get(first, 0) + 1}
            found.append(tuple(sorted(both.items(), reverse=True)))
    return found[:tried]


def plan(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> list[tuple[Filling, int]]:
    """Fillings and how many sequences get each; every piece is in exactly one."""
    counts = {int(n): int(c) for n, c in counts.items() if c}
    if bad := [n for n in counts if not 0 < n <= capacity]:
        raise ValueError(f"lengths outside 1 to {capacity}: {sorted(bad)[:5]}")
    best = best_fit(counts, capacity)
    left = np.zeros(capacity + 1, np.int64)
    for n, c in counts.items():
        left[n] = c
    used, least = sum(k for _, k in best), lower_bound(left, capacity)
    chosen: list[tuple[Filling, int]] = []
    sequences = 0

    def choices() -> Iterator[tuple[Filling, int]]:
        for filling in fillings(left, capacity):
            most = min(int(left[n]) // k for n, k in filling)
            yield filling, most
            if most > 1:
                yield filling, 1

    stack = [choices()] if used > least else []
    while stack and used > least and nodes > 0:
        step = next(stack[-1], None)
        if step is None:
            stack.pop()
            if chosen:
                filling, times = chosen.pop()
                sequences -= times
                for n, k in filling:
                    left[n] += k * times
            continue
        nodes -= 1
        filling, times = step
        for n, k in filling:
            left[n] -= k * times
        chosen.append(step)
        sequences += times
        if not left.any():
            if sequences < used:
                best, used = list(chosen), sequences
            stack.append(iter(()))
        elif sequences + lower_bound(left, capacity) >= used:
            stack.append(iter(()))  # the waste so far leaves no way below the best
        else:
            stack.append(choices())
    return best


# --- places of pieces


class Places:
    """Sequence and offset of the piece of a rank among those of its length."""

    def __init__(self, planned: list[tuple[Filling, int]]):
        rows, taken, sequence = [], defaultdict(int), 0
        for filling, times in planned:
            offset = 0
            for length, each in filling:
                rows.append((length, taken[length], each, sequence, offset))
                taken[length] += each * times
                offset += length * each
            sequence += times
        rows.sort()
        self.length, self.rank, self.each, self.sequence, self.offset = np.array(rows, np.int64).reshape(-1, 5).T

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.empty(len(length), np.int64)
        for n in np.unique(length):
            own = np.flatnonzero(length == n)
            first, last = np.searchsorted(self.length, [n, n + 1])
            at[own] = first + np.searchsorted(self.rank[first:last], rank[own], "right") - 1
        further = rank - self.rank[at]
        return self.sequence[at] + further // self.each[at], self.offset[at] + further % self.each[at] * length


def pack(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    length: str = "length",
    nodes: int = NODES,
) -> DataFrame:
    """All columns plus ``sequence_id`` and ``offset``; offsets of a sequence have no gaps.

    The pieces are written first, as they are read twice. A length that many pieces have is ranked
    in as many tasks as its count needs.
    """
    if clash := sorted({"sequence_id", "offset"} & set(pieces.columns)):
        raise ValueError(f"columns have names of result columns: {', '.join(clash)}")
    kept, number = pieces.schema, F.monotonically_increasing_id()
    rows = pieces.select(F.struct(*[F.col(f"`{c}`") for c in pieces.columns]).alias("row"), F.col(length).cast("long").alias("length"), number.alias("number"))
    rows = materialise(rows, "pieces")
    counts = dict(rows.groupBy("length").count().collect())  # at most one row for each length
    places = Places(plan(counts, capacity, nodes))
    parts = {n: -(-c // RANKED) for n, c in counts.items() if c > RANKED}
    part = F.lit(0)
    if parts:
        among = F.get(F.array(*[F.lit(parts.get(n, 1)) for n in range(capacity + 1)]), F.col("length").cast("int"))
        part = F.pmod(F.xxhash64("number"), among.cast("long")).cast("int")
    rows = rows.withColumn("part", part)
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("length", "part").orderBy("number")) - 1)
    if parts:
        sizes = rows.where(F.col("length").isin(list(parts))).groupBy("length", "part").count()
        earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        before = sizes.select("length", "part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
        ranked = ranked.join(before, ["length", "part"], "left")
        ranked = ranked.withColumn("rank", F.col("rank") + F.coalesce("before", F.lit(0)))
    schema = T.StructType([T.StructField("row", kept), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = places.of(batch.column(1).to_numpy(), batch.column(2).to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, found)], names=schema.fieldNames())

    return ranked.select("row", "length", F.col("rank").cast("long")).mapInArrow(run, schema).select("row.*", "sequence_id", "offset")


# --- ids


LETTERS = {bytes([b]) for b in range(97, 123)}
LOWER = bytes([*range(65), *range(97, 123), *range(91, 256)])


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class _Known(dict[bytes, bytes]):
    """Ids of parts; one that is missing is encoded, and remembered unless it is long."""

    def __init__(self, path: str):
        super().__init__({b"": b""})
        tokenizer = _tokenizer(path)
        self.encode, self.merge = tokenizer.encode, tokenizer.model.tokenize
        self.characters = byte_table()
        self.old: dict[bytes, bytes] = {}

    def encoded(self, part: bytes) -> bytes:
        text = part.decode()
        if text.isalpha() and max(text) < "\u0250" and text == text.lower() and is_normalized("NFC", text):
            ids = [t.id for t in self.merge(part.decode("latin-1").translate(self.characters))]  # one word as it is
        else:
            ids = self.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, part: bytes) -> bytes:
        ids = self.old.get(part)
        if ids is None:
            stopped = part[-1:] in (b".", b",") and part[-2:-1] in LETTERS
            ids = self[part[:-1]] + self[part[-1:]] if stopped else self.encoded(part)
        if len(part) <= LONGEST:
            self[part] = ids
        return ids

    def turn(self) -> None:
        self.old = dict(self)
        self.clear()
        self[b""] = b""


class Encoder:
    """Ids of texts, for a vocabulary of lower-case words that never reach over white space.

    Texts are cut at spaces and line breaks, and each different part is encoded once while it is
    remembered. A to Z are lower-cased first, which the vocabulary does as well, unless a text has
    characters that may combine with them or may spell a special token. A full stop or comma after
    a letter is a word of its own, so the part before it is looked up without it. A part of Latin
    letters in lower case is one word and goes to the library's model at once. Two tables of
    bounded size take turns: what is still in use moves to the new one.
    """

    def __init__(self, path: str):
        self.known = _Known(path)

    def __call__(self, raw: bytes) -> bytes:
        """The ids of a text in UTF-8 as little-endian 32-bit numbers."""
        if not (b"\xcc" in raw or b"\xcd" in raw or b"<|" in raw):
            raw = raw.translate(LOWER)
        if len(self.known) > REMEMBERED:
            self.known.turn()
        return b"".join(map(self.known.__getitem__, raw.replace(b"\n", b" ").split(b" ")))


def pieces(
    docs: DataFrame,
    vocabulary: str,
    end_id: int = 1,
    capacity: int = CAPACITY,
    text: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """The id, ``piece``, ``start``, ``length`` and ``ids`` (as bytes of 32-bit numbers) of every piece."""
    schema = T.StructType([docs.schema[id_col], T.StructField("piece", T.IntegerType())])
    schema.add("start", T.LongType()).add("length", T.LongType()).add("ids", T.BinaryType())
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            rows, numbers, ids, size = [], [], [], 0

            def out():
                owner = batch.column(0).take(pa.array(rows, pa.int64()))
                columns = [pa.array(x, k) for x, k in zip(zip(*numbers, strict=True), (pa.int32(), pa.int64(), pa.int64()), strict=True)]
                return pa.RecordBatch.from_arrays([owner, *columns, pa.array(ids, pa.binary())], names=schema.fieldNames())

            for row, value in enumerate(batch.column(1).cast(pa.large_binary())):
                own = encoder(value.as_py() or b"") + end
                for k, start in enumerate(range(0, len(own), 4 * capacity)):
                    cut = own[start : start + 4 * capacity]
                    rows.append(row)
                    numbers.append((k, start // 4, len(cut) // 4))
                    ids.append(cut)
                    size += len(cut) // 4
                    if size > IDS_OUT:
                        yield out()
                        rows, numbers, ids, size = [], [], [], 0
            if rows:
                yield out()

    return docs.select(F.col(id_col), F.col(text)).mapInArrow(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """One row for each sequence: its ids as an array, and the ids of its documents in order.

    A group is one sequence, so it has at most the capacity of ids.
    """
    byte = "substring(hex(ids), i * 8 + {}, 2)"
    number = "cast(conv(concat(" + ", ".join(byte.format(k) for k in (7, 5, 3, 1)) + "), 16, 10) AS int)"
    from_bytes = F.expr(f"transform(sequence(0, cast(length AS int) - 1), i -> {number})")
    rows = packed.select("sequence_id", F.struct("offset", "doc_id", from_bytes.alias("ids")).alias("part"))
    grouped = rows.groupBy("sequence_id").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    return grouped.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
