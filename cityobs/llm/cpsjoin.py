"""Near-duplicate classes by a chosen-path set similarity join over minwise hashes.

A document's set is its distinct five-word shingles. Copies (equal words) are one class from the
start; one document of each class goes on. Every tree deals the documents from its root down: a
node picks one of the minwise coordinates, sometimes a second one (1 / threshold in the mean, so that
a pair at the threshold keeps one common path in the mean at any depth), and a document goes to the
child of its value there. Nodes of few documents are compared exhaustively, larger ones are dealt
again. There are as many trees as would, were they independent, all miss a pair at the threshold with a
chance below one in a million, and three more, as they share the coordinates. In a simulation of pairs
that must pass three levels 4 of 2,000,000 were missed at 0.85 (15 trees) and 1 at 0.80 (17 trees).

What a node finds is compared by 128-bit sketches first, then on the full sets. To keep work linear
in groups of near copies, every document is first confirmed against the smallest id of its nodes;
other pairs are confirmed only between documents that this has not brought together. Documents of
nodes that are still large at the greatest depth lie in dense groups, whose documents are nearly
as alike as links need. They are compared exactly, block by block: no pair of them is a row, and
what a task gives are the links that bring classes together, fewer than it has documents.

Lower-cased are A to Z; words are runs of anything but ASCII white space. Defined cases: a text
without words (or null) has an empty set and is linked with nothing; fewer words than five are one
shingle together; rows that share an id are one document whose texts are linked; a row with a null
id is linked with nothing, has a null component and is kept; of equal ids in a group the smallest
is the component; an empty table gives an empty table; other columns pass through by name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityobs.scratch import materialise

SHINGLE = 5
#: Links need 100 * intersection >= PERCENT * union, unless a caller names another threshold.
PERCENT = 85
#: Minwise coordinates that trees branch on, and that sketches have a bit of.
COORDINATES, BITS = 64, 128
#: Documents of a node that are compared exhaustively.
SMALL = 16
#: Levels of a tree.
DEPTH = 3
#: Chance that independent trees all miss a pair at the threshold, at most.
MISSED = 1e-6
#: Trees beyond those, as trees share their coordinates and so are not independent.
SPARE = 3
#: Documents that one task compares with one centre.
CHUNK = 500
#: Hashes of a block of documents that trees do not part; a longer set is a block of its own.
BLOCK_HASHES = 50_000
#: Bits of the filter by which texts are read for confirmation.
FILTER_BITS = 1 << 23

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xBF58476D1CE4E5B9)
_random = np.random.default_rng(20_240_607)
_MULTIPLY = _random.integers(1, 1 << 63, BITS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _random.integers(0, 1 << 63, BITS, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _A
    x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(found: list[bytes]) -> np.ndarray:
    """64-bit hashes of the distinct shingles, ascending."""
    if not found:
        return np.zeros(0, np.uint64)
    each = np.array([xxhash.xxh3_64_intdigest(w) for w in found], np.uint64)
    n = min(SHINGLE, len(each))
    h = np.full(len(each) - n + 1, n, np.uint64)
    for k in range(n):
        h = _mix(h * _A + each[k : len(each) - n + 1 + k])
    return np.unique(h)


def minwise(hashes: np.ndarray) -> np.ndarray:
    """Smallest 32-bit value of the shingles under each of the hash functions."""
    out = np.full(BITS, 0xFFFFFFFF, np.uint64)
    for start in range(0, len(hashes), 512):
        block = hashes[start : start + 512, None] * _MULTIPLY + _ADD
        np.minimum(out, (block >> np.uint64(32)).min(axis=0), out=out)
    return out


def children(nodes: np.ndarray, values: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Rows and children of nodes, given the coordinates (one row each) of the documents in them."""
    drawn = _mix(nodes ^ _B)
    rows, out = [], []
    twice = (drawn >> np.uint64(40)) % np.uint64(10_000) < np.uint64(round(1e6 / percent - 1e4))
    for k, which in enumerate((np.arange(len(nodes)), np.flatnonzero(twice))):
        pick = ((drawn[which] >> np.uint64(7 * k)) % np.uint64(COORDINATES)).astype(np.int64)
        if k:  # another coordinate than the first one
            first = (drawn[which] % np.uint64(COORDINATES)).astype(np.int64)
            pick = np.where(pick == first, (pick + 1) % COORDINATES, pick)
        value = values[which, pick].astype(np.uint64)
        out.append(_mix(_mix(nodes[which] + np.uint64(k + 1)) ^ (value + (pick.astype(np.uint64) << np.uint64(32)))))
        rows.append(which)
    return np.concatenate(rows), np.concatenate(out)


def trees(percent: int) -> int:
    """Trees that together miss a pair at the threshold with a chance below ``MISSED``, and spare ones."""
    p, lost = percent / 100, 0.0
    for _ in range(DEPTH):
        one = 1 - p + p * lost  # a child's documents are not both there, or part further down
        lost = (2 - 1 / p) * one + (1 / p - 1) * one * one
    return SPARE + max(1, math.ceil(math.log(MISSED) / math.log(lost))) if lost else 1


def equal_bits(percent: int) -> int:
    """Equal sketch bits that a pair needs: six deviations below what the threshold lets expect."""
    p = (1 + percent / 100) / 2
    return math.floor(BITS * p - 6 * math.sqrt(BITS * p * (1 - p)))


def _roots(percent: int) -> np.ndarray:
    """Roots of the trees; no two pick the same first coordinate while there are others."""
    some = _mix(np.arange(1, 100 * COORDINATES, dtype=np.uint64) * _A)
    _, first = np.unique(_mix(some ^ _B) % np.uint64(COORDINATES), return_index=True)
    order = np.concatenate([np.sort(first), np.setdiff1d(np.arange(len(some)), first)])
    return some[order[: trees(percent)]]


EQUAL_BITS = equal_bits(PERCENT)
_ROOTS = _roots(PERCENT)


def sketches(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """For ``id`` and ``text``: class key, set size, two sketch words, first nodes and coordinates."""
    names = ["id", "key", "n", "b0", "b1", "nodes", "values"]
    roots = _roots(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                out = [[] for _ in names[1:]]
                for t in batch.column(1).slice(start, 1000).to_pylist():
                    found = words(t)
                    hashes = shingles(found)
                    least = minwise(hashes)
                    bits = np.packbits((_mix(least) >> np.uint64(17)).astype(np.uint8) & 1).view(np.int64)
                    mine = least[:COORDINATES]
                    _, first = children(roots, np.broadcast_to(mine, (len(roots), COORDINATES)), percent)
                    values = (xxhash.xxh3_128_digest(b" ".join(found)), len(hashes), int(bits[0]), int(bits[1]))
                    for column, value in zip(out, (*values, first.view(np.int64), mine.astype(np.uint32).view(np.int32)), strict=True):
                        column.append(value)
                types = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32())]
                arrays = [pa.array(x, k) for x, k in zip(out, types, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, 1000), *arrays], names=names)

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, key binary, n long, b0 long, b1 long, nodes array<long>, values array<int>")


def _deeper(rows: DataFrame, vectors: DataFrame, percent: int) -> DataFrame:
    """The next level's rows of documents in large nodes; a document meets its coordinates once for all its nodes."""
    schema = rows.schema
    each = rows.groupBy("id", "n", "b0", "b1").agg(F.collect_list("node").alias("nodes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(start, 1000) for whole in batches for start in range(0, whole.num_rows, 1000)):
            lists = batch.column(4)
            owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            nodes = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            values = np.array(batch.column(5).to_pylist(), np.int32).view(np.uint32).reshape(batch.num_rows, -1)
            which, out = children(nodes, values[owner], percent)
            at = pa.array(owner[which])
            kept = [batch.column(k).take(at) for k in range(4)]
            yield pa.RecordBatch.from_arrays([pa.array(out.view(np.int64)), *kept], names=schema.fieldNames())

    return each.join(vectors, "id").select("id", "n", "b0", "b1", "nodes", "values").mapInArrow(run, schema)


def _close(a: str, b: str, percent: int) -> Column:
    """Whether sizes allow a link and sketches make one likely."""
    sizes = F.least(F.col(f"{a}n"), F.col(f"{b}n")) * 100 >= F.greatest(F.col(f"{a}n"), F.col(f"{b}n")) * percent
    differ = sum(F.bit_count(F.col(f"{a}{c}").bitwiseXOR(F.col(f"{b}{c}"))) for c in ("b0", "b1"))
    return sizes & (differ <= BITS - equal_bits(percent))


def _stars(nodes: DataFrame, centres: DataFrame, percent: int) -> DataFrame:
    """Documents and the smallest id of their node, if they are close."""
    met = nodes.join(centres, "node").where(F.col("id") != F.col("c.id"))
    flat = met.select("id", "n", "b0", "b1", *(F.col(f"c.{x}").alias(f"c_{x}") for x in ("id", "n", "b0", "b1")))
    return flat.where(_close("", "c_", percent)).select(F.col("id").alias("b"), F.col("c_id").alias("a"))


def _small_pairs(nodes: DataFrame, percent: int) -> DataFrame:
    """All close pairs of nodes of a few documents."""
    group = nodes.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("id", "n", "b0", "b1"))).alias("m"))
    first = group.select(F.posexplode("m").alias("i", "x"), "m")
    second = first.select("x.*", F.explode(F.slice("m", F.col("i") + 2, F.greatest(F.size("m") - F.col("i") - 1, F.lit(0)))).alias("y"))
    flat = second.select("id", "n", "b0", "b1", *(F.col(f"y.{x}").alias(f"y_{x}") for x in ("id", "n", "b0", "b1")))
    return flat.where((F.col("id") != F.col("y_id")) & _close("", "y_", percent)).select(F.col("id").alias("a"), F.col("y_id").alias("b"))


def _slots(ids: DataFrame) -> bytes:
    """A filter of fixed size that holds all these ids."""
    slot = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS)) + 1
    rows = (
        ids.select(slot.alias("slot"))
        .groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
        .collect()
    )
    out = bytearray(FILTER_BITS // 8)
    size = 32768 // 8
    for r in rows:
        out[(r["bucket"] - 1) * size : r["bucket"] * size] = r["bits"]
    return bytes(out)


def _sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``id`` and ``set`` (bytes of its hashes) of the texts that a filter of ``ids`` lets through."""
    wanted = _slots(ids)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(wanted, np.uint8)
        for batch in batches:
            slots = batch.column(2).to_numpy(zero_copy_only=False)
            at = np.flatnonzero(bits[slots >> 3] >> (slots & 7) & 1)
            for start in range(0, len(at), 1000):
                some = pa.array(at[start : start + 1000])
                sets = [shingles(words(t)).tobytes() for t in batch.column(1).take(some).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(some), pa.array(sets, pa.binary())], names=["id", "set"])

    slot = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text", slot.alias("slot")).mapInArrow(read, f"id {kind}, set binary")


def confirm(pairs: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs ``a``, ``b`` that are links on their full sets.

    Only texts that the pairs name are turned into sets. A set travels to the centre (``a``) of its
    pair; a centre of many pairs is copied to as many tasks as they need, and a task holds one
    centre's set at a time.
    """
    chunks = pairs.groupBy("a").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    asked = materialise(
        pairs.join(chunks, "a")
        .select(F.col("b").alias("id"), "a", F.pmod(F.xxhash64("b"), "chunks").cast("int").alias("part"), F.lit(False).alias("centre"))
        .unionByName(
            chunks.select(
                F.col("a").alias("id"),
                "a",
                F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("part"),
                F.lit(True).alias("centre"),
            )
        ),
        "join-asked",
    )
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, None
        for batch in (whole.slice(start, 500) for whole in batches for start in range(0, whole.num_rows, 500)):
            a, b = [], []
            for centre, part, first, i, blob in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                found = np.frombuffer(blob, np.uint64)
                if first:
                    at, own = (centre, part), found
                elif at == (centre, part):
                    common = len(np.intersect1d(own, found, assume_unique=True))
                    if 100 * common >= percent * (len(own) + len(found) - common):
                        a.append(centre)
                        b.append(i)
            kind = batch.column(0).type
            yield pa.RecordBatch.from_arrays([pa.array(a, kind), pa.array(b, kind)], names=["a", "b"])

    kind = docs.schema["id"].dataType.simpleString()
    sets = _sets(docs, asked)
    return (
        asked.join(sets, "id")
        .select("a", "part", "centre", "id", "set")
        .repartition(F.col("a"), F.col("part"))
        .sortWithinPartitions("a", "part", F.col("centre").desc(), "id")
        .mapInArrow(compare, f"a {kind}, b {kind}")
    )


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``label`` (smallest id reachable) of every id in the edges ``a``, ``b``.

    Each round every id points to its smallest smaller neighbour, pointers are followed twice, and
    the edges are drawn anew between what they lead to, until none is left.
    """

    def clean(df: DataFrame) -> DataFrame:
        return df.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    left = materialise(clean(edges), "links")
    labels = left.select(F.col("a").alias("id")).union(left.select("b")).distinct().withColumn("label", F.col("id"))
    while not left.isEmpty():
        up = left.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("to"))
        for _ in range(2):
            over = up.select(F.col("id").alias("to"), F.col("to").alias("next"))
            up = materialise(up.join(over, "to", "left").select("id", F.coalesce("next", "to").alias("to")), "pointers")
        labels = materialise(
            labels.join(up.select(F.col("id").alias("label"), "to"), "label", "left").select("id", F.coalesce("to", "label").alias("label")),
            "labels",
        )
        for end in ("a", "b"):
            left = left.join(up.select(F.col("id").alias(end), "to"), end, "left").select(
                F.coalesce("to", end).alias(end), "b" if end == "a" else "a"
            )
        left = materialise(clean(left), "links")
    return labels


def _labelled(rows: DataFrame, labels: DataFrame, column: str, into: str) -> DataFrame:
    """``rows`` with the label of a column, which is the id itself if it has none."""
    named = labels.select(F.col("id").alias(column), F.col("label").alias("__label"))
    return rows.join(named, column, "left").withColumn(into, F.coalesce("__label", column)).drop("__label")


def _merge(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links between ids."""
    drawn = _labelled(_labelled(links, labels, "a", "x"), labels, "b", "y")
    more = components(drawn.select(F.col("x").alias("a"), F.col("y").alias("b")))
    old = _labelled(labels, more.select("id", "label"), "label", "to").select("id", F.col("to").alias("label"))
    return materialise(old.unionByName(more.join(labels, "id", "left_anti")), "labels")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends have different labels."""
    both = _labelled(_labelled(pairs, labels, "a", "x"), labels, "b", "y")
    return both.where(F.col("x") != F.col("y")).select("a", "b")


def link(docs: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Class of every row (``id``, ``n``, ``rep``) and labels (``id``, ``label``) of linked classes."""
    seen = materialise(sketches(docs.where(F.col("id").isNotNull()), percent), "sketches")
    reps = materialise(seen.groupBy("key").agg(F.min("id").alias("rep")), "classes")
    members = seen.select("id", "key", "n").join(reps, "key").drop("key")
    own = seen.where(F.col("n") > 0).join(reps.select(F.col("rep").alias("id")).distinct(), "id", "left_semi").dropDuplicates(["id", "key"])
    single = materialise(own.select("id", "n", "b0", "b1", "nodes", "values"), "class-sketches")
    rows = single.select(F.explode("nodes").alias("node"), "id", "n", "b0", "b1")
    vectors = None
    stars, pairs, dense = [], [], None
    for level in range(1, DEPTH + 1):
        least = F.min(F.struct("id", "n", "b0", "b1")).alias("c")
        sizes = materialise(rows.groupBy("node").agg(F.count("*").alias("size"), least).where(F.col("size") > 1), f"nodes-{level}")
        shared = materialise(rows.join(sizes.select("node", "size"), "node"), f"node-rows-{level}")
        nodes = shared.drop("size")
        stars.append(_stars(nodes, sizes.select("node", "c"), percent))
        pairs.append(_small_pairs(shared.where(F.col("size").between(3, SMALL)).drop("size"), percent))
        large = shared.where(F.col("size") > SMALL).drop("size")
        if level == DEPTH:
            dense = large
        elif large.isEmpty():
            break
        else:
            if vectors is None:
                few = large.select("id").distinct()
                vectors = materialise(single.select("id", "values").join(few, "id", "left_semi"), "vectors")
            rows = materialise(_deeper(large, vectors, percent), f"children-{level}")
    texts = docs.select("id", "text")
    star = materialise(_union(stars).distinct(), "star-pairs")
    labels = components(materialise(confirm(star, texts, percent), "star-links"))
    rest = materialise(_apart(_union(pairs).distinct().join(star, ["a", "b"], "left_anti"), labels), "other-pairs")
    if not rest.isEmpty():
        labels = _merge(labels, materialise(confirm(rest, texts, percent), "other-links"))
    if dense is not None and not dense.isEmpty():
        labels = _merge(labels, materialise(_dense_links(dense.select("node", "id"), labels, texts, percent), "dense-links"))
    return members, labels


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


class _Linked:
    """Documents of a block with the classes that they are known to be in."""

    def __init__(self, labels: list):
        place = {label: k for k, label in enumerate(dict.fromkeys(labels))}
        self.of = [place[x] for x in labels]
        self.up = list(range(len(place)))

    def find(self, k: int) -> int:
        k = self.of[k]
        while self.up[k] != k:
            self.up[k] = self.up[self.up[k]]
            k = self.up[k]
        return k

    def join(self, a: int, b: int) -> bool:
        """Whether this brings two classes together."""
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def block_links(first: list[np.ndarray], second: list[np.ndarray], labels: list, percent: int) -> list[tuple[int, int]]:
    """Links between two blocks of sets (or within one, if the second is empty) that bring classes together.

    ``labels`` are those of both blocks; the numbers of the second go on after the first. Common
    hashes of a set and all sets of the first block are counted at once, from the places of its
    hashes in the sorted hashes of that block.
    """
    others = second or first
    shift = len(first) if second else 0
    linked, found = _Linked(labels), []
    sizes = np.array([len(x) for x in first], np.int64)
    owner = np.repeat(np.arange(len(first)), sizes)
    hashes = np.concatenate(first)
    order = np.argsort(hashes, kind="stable")
    hashes, owner = hashes[order], owner[order]
    for b, own in enumerate(others):
        low, high = np.searchsorted(hashes, own), np.searchsorted(hashes, own, "right")
        times = high - low
        where = np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())
        common = np.bincount(owner[where], minlength=len(first))
        near = 100 * common >= percent * (sizes + len(own) - common)
        for a in np.flatnonzero(near if second else near[:b]).tolist():
            if linked.join(a, shift + b):
                found.append((a, shift + b))
    return found


def _dense_links(dense: DataFrame, labels: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links that bring classes together among documents that the trees do not part.

    Documents of a node, and of nodes that share documents, are a group. A group is cut into blocks
    of about ``BLOCK_HASHES`` hashes, and every two blocks meet in one task, which compares all of
    their sets. So a set travels once for each block of its group, no pair of documents is a row, and a task
    gives fewer links than it has documents.
    """
    least = dense.groupBy("node").agg(F.min("id").alias("a"))
    groups = components(dense.select("node", F.col("id").alias("b")).join(least, "node").select("a", "b").distinct())
    groups = groups.withColumnRenamed("label", "group")
    sets = _sets(texts, groups.select("id")).join(groups, "id").dropDuplicates(["id", "set"])
    sets = materialise(_labelled(sets, labels, "id", "label").select("id", "group", "label", "set"), "dense-sets")
    blocks = sets.groupBy("group").agg(
        F.ceil(F.sum(F.octet_length("set")) / (8 * BLOCK_HASHES)).cast("int").alias("blocks"),
        F.count_distinct("label").alias("classes"),
    )
    own = F.pmod(F.xxhash64("id"), "blocks").cast("int")
    met = sets.join(blocks.where("classes > 1"), "group").withColumn("own", own)
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = met.select(
        "group", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).alias("later"), "id", "label", "set"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sides = None, ([], [])

        def done() -> pa.RecordBatch:
            both = sides[0] + sides[1]
            first, second = ([np.frombuffer(x[2], np.uint64) for x in side] for side in sides)
            # Two different blocks of which one is empty have been compared where each meets itself.
            alone = at is not None and at[1] != at[2] and not (first and second)
            found = block_links(first, second, [x[1] for x in both], percent) if first and not alone else []
            return pa.RecordBatch.from_arrays([pa.array([both[x[k]][0] for x in found], kind) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            kind = batch.column(4).type
            for group, i, j, later, doc, label, blob in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                if (group, i, j) != at:
                    if at is not None:
                        yield done()
                    at, sides = (group, i, j), ([], [])
                sides[later].append((doc, label, blob))
        if at is not None:
            yield done()

    kind = texts.schema["id"].dataType.simpleString()
    dealt = rows.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j", "later", "id")
    return dealt.mapInArrow(compare, f"a {kind}, b {kind}")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """Id, ``n_shingles``, ``component_id`` and ``kept`` of every row, linked from ``percent`` of similarity on."""
    docs = df.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    members, labels = link(docs, percent)
    empty = F.col("n") == 0
    found = _labelled(members, labels, "rep", "component").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(empty, F.col("id")).otherwise(F.col("component")).alias("component_id"),
    )
    nameless = df.where(F.col(id_col).isNull()).select(id_col, text)
    counted = sketches(nameless.select(F.col(id_col).alias("id"), F.col(text).alias("text"))).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("id").alias("component_id")
    )
    return found.unionByName(counted).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
