import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_cases import make_prose, odd, table  # noqa: F401

from cityobs.llm import crc, importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def grams(text):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def by_hand(docs, target, percent, seed=42):
    bucket = lambda g: zlib.crc32(g.encode()) % importance.BUCKETS
    counts = [np.zeros(importance.BUCKETS, int) for _ in range(2)]
    for side, texts in zip(counts, ([t for _, t in docs], target), strict=True):
        for t in texts:
            for g in grams(t)[1]:
                side[bucket(g)] += 1
    s, t = counts
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (s.sum() + 10000) / ((s[b] + 1) * (t.sum() + 10000)))) for b in range(10000)
    ]
    out = []
    for i, text in docs:
        words, own = grams(text)
        weight = sum(gain[bucket(g)] for g in own)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(words), len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    fit = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    for place, r in enumerate(fit[: percent * len(fit) // 100], 1):
        r[5] = place
    return sorted(map(tuple, out), key=repr)


def test_spans_match_the_plain_checksum():
    pick = random.Random(1)
    data = np.frombuffer(pick.randbytes(120_000), np.uint8)
    sizes = [0, 1, 2, 63, 64, 65, 127, 128, 129, 4097, 99_999, *(pick.randrange(300) for _ in range(500))]
    starts = np.array([pick.randrange(len(data) - n) for n in sizes])
    got = crc.span_crc32(data, starts, starts + sizes)
    assert got.tolist() == [zlib.crc32(data[a : a + n].tobytes()) for a, n in zip(starts.tolist(), sizes, strict=True)]
    assert len(crc.span_crc32(data, starts[:0], starts[:0])) == 0


def test_weights_and_draw_match_plain_python(table, odd, make_prose):
    texts = [(100 + k, make_prose(15 + k % 40, k)) for k in range(300)]
    texts += [(k, make_prose(30, 7)) for k in range(500, 510)]  # equal texts
    texts += [(600, "x" * 5000 + " y " + "é東" * 3000), (601, " ".join(["Z9"] * 25))]
    rows = texts + odd
    target = table([(1, make_prose(200, 3)), (2, None), (3, "amber1 birch2")])
    got = importance.resample(table(rows), target, 20).collect()
    want = by_hand(rows, [make_prose(200, 3), None, "amber1 birch2"], 20)
    assert sorted(map(tuple, got), key=repr) == want


def test_kept_columns_and_their_names(table, odd):
    docs = table(odd)
    drawn = importance.resample(docs, docs, 50, keep=("text", "n", "id", "spans"))
    assert drawn.columns == ["doc_id", "text", "n", "id", "spans", *importance.RESULTS]
    assert drawn.count() == len(odd) and {r["n"] for r in drawn.collect()} == {7}
    with pytest.raises(ValueError, match="score"):
        importance.resample(docs, docs, 50, keep=("score",))


def test_empty_tables(table, odd):
    none, some = table([]), table(odd)
    assert importance.resample(none, some, 5).count() == 0
    assert importance.resample(some, none, 5).count() == len(odd)


def test_repeated_ids_get_places_of_their_own(table, make_prose):
    docs = table([(1, make_prose(40, 1))] * 30 + [(2, make_prose(40, 2))] * 10)
    ranks = importance.resample(docs, docs, 100).where(F.col("rank").isNotNull()).select("rank").collect()
    assert sorted(r[0] for r in ranks) == list(range(1, 41))
