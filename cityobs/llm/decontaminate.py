"""Benchmark decontamination: exact containment of item windows by a prefix-filtered set join.

A window is ``width`` consecutive words of an item (an item of fewer words is one window). For a
document to contain a window it must contain every word of it, so one word is prefix enough: the
rarest by the number of documents that hold it. Documents are joined on those words only; the
word's place in the window gives where the window must start and end, and candidates within the
document are compared word by word.

Only A to Z are lower-cased; words are runs of ASCII digits and letters and of other characters
beyond ASCII. Defined cases: a null or empty text has no words, is hit by nothing and, as an item,
has no window; rows are told apart by id and text, so rows that share both get the same result and
null ids are an id like others; a null item id is the empty string; items with the same window
share it; empty tables on either side give no hits; other columns pass through by name, one named
like a result (``n_words``, ``n_hit``, ``items``) with ``_input`` after its name.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityobs.llm.columns import unpacked, whole
from cityobs.scratch import materialise

WIDTH = 10
#: Everything that ends a word, after lower-casing A to Z.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Windows (some hundred bytes each) that are broadcast; more are joined by a shuffle.
BROADCAST_WINDOWS = 100_000
#: Prefix words (about 50 bytes each) that are broadcast to sift the documents' words.
BROADCAST_WORDS = 1_000_000


def words(text: Column) -> Column:
    """Words of a text; the general lower-casing is used where it does the same."""
    raw = F.coalesce(text, F.lit(""))
    lowered = F.when(F.length(raw) == F.octet_length(raw), F.lower(raw)).otherwise(
        F.translate(raw, string.ascii_uppercase, string.ascii_lowercase)
    )
    return F.filter(F.split(lowered, SEPARATORS), lambda w: w != "")


def _key(id_col: str, text: str) -> Column:
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text)).alias("text")).alias("key")


def item_windows(items: DataFrame, item_col: str = "item_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """Item id as a string and the words of each of its different windows."""
    split = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), words(F.col(text)).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (width - 1), F.lit(1)))
    return (
        split.where(F.size("w") > 0)
        .select("item", "w", F.explode(starts).alias("s"))
        .select("item", F.slice("w", F.col("s"), F.lit(width)).alias("window"))
        .distinct()
    )


def prefixes(docs_words: DataFrame, windows: DataFrame, few: bool) -> DataFrame:
    """Each different window with its rarest word and that word's first place in it."""
    vocabulary = windows.select(F.explode("window").alias("word")).distinct()
    held = docs_words.select(F.explode(F.array_distinct("w")).alias("word"))
    if few:
        counts = held.join(F.broadcast(vocabulary), "word").groupBy("word").count()
    else:  # counted first, so that a frequent word is one row of each task
        counts = held.groupBy("word").count().join(vocabulary, "word")
    places = windows.select("window", F.posexplode("window").alias("place", "word"))
    rarity = F.struct(F.coalesce("count", F.lit(0)), "word", "place")
    return (
        places.join(counts, "word", "left")
        .groupBy("window")
        .agg(F.min(rarity).alias("r"))
        .select("window", F.col("r.word").alias("word"), F.col("r.place").alias("place"))
    )


def occurrences(docs: DataFrame, windows: DataFrame, few: bool, width: int = WIDTH) -> DataFrame:
    """``key``, ``start`` and ``window`` of every occurrence, from ``key`` and ``w`` of documents."""
    if few:
        at = docs.select("key", "w", F.posexplode("w").alias("pos", "word"))
        start = F.col("pos") - F.col("place")
        size = F.size("window")
        return (
            at.join(F.broadcast(windows), "word")
            .where((start >= 0) & (start + size <= F.size("w")))
            .where(F.slice("w", start + 1, size) == F.col("window"))
            .select("key", start.alias("start"), "window")
        )
    # Beyond the bound only words that begin some window are shuffled, and each document once.
    heads = materialise(windows.select("word").distinct(), "prefix-words")
    heads = F.broadcast(heads) if heads.count() <= BROADCAST_WORDS else heads
    at = docs.select("key", F.posexplode("w").alias("pos", "word")).join(heads, "word", "left_semi")
    start = F.col("pos") - F.col("place")
    asked = at.join(windows, "word").where(start >= 0).select("key", start.alias("start"), "window").distinct()
    once = docs.dropDuplicates(["key"])
    return (
        asked.join(once, "key")
        .where(F.col("start") + F.size("window") <= F.size("w"))
        .where(F.slice("w", F.col("start") + 1, F.size("window")) == F.col("window"))
        .select("key", "start", "window")
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    broadcast_windows: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit`` (words inside occurrences) and ``items`` (sorted ids)."""
    owned = materialise(item_windows(items, item_col, item_text, width), "windows")
    distinct = owned.select("window").distinct()
    few = distinct.count() <= broadcast_windows
    split = docs.select(_key(id_col, text), words(F.col(text)).alias("w"))
    rare = materialise(prefixes(split, distinct, few), "window-prefixes")
    found = materialise(occurrences(split, rare, few, width), "window-hits")
    spans = F.collect_set(F.struct("start", F.size("window").alias("size")))
    covered = F.flatten(F.transform(F.col("spans"), lambda s: F.sequence(s["start"], s["start"] + s["size"] - 1)))
    hits = (
        found.groupBy("key").agg(spans.alias("spans")).select("key", F.size(F.array_distinct(covered)).cast("long").alias("n_hit"))
    )
    of = F.broadcast(owned) if few else owned
    ids = (
        found.select("key", "window")
        .distinct()
        .join(of, "window")
        .groupBy("key")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    marks = hits.join(ids, "key")
    counted = whole(docs, _key(id_col, text).alias("row_key"), F.size(words(F.col(text))).cast("long").alias("n_words"))
    joined = counted.join(marks, F.col("row_key") == F.col("key"), "left")
    return joined.select(
        *unpacked(docs, ["n_words", "n_hit", "items"]),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
